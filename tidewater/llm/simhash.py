"""SimHash near-duplicates by covering locality-sensitive hashing (operator 6).

Fingerprint: 64 bits over the XXH64 (seed 42) of every word shingle, repeats
included; a bit is set if more than half of the hashes have it.

Covering masks: every bit position gets a non-zero vector of ``radius + 1``
bits; table ``v`` (a non-zero vector) ignores the positions whose vector is
orthogonal to ``v``. Any ``radius`` vectors leave some ``v`` orthogonal to all
of them, so two fingerprints within the radius agree in the masked bits of at
least one of the ``2 ** (radius + 1) - 1`` tables: no pair is missed.

Copies collapse to distinct fingerprints first. In a bucket of up to
``bucket_limit`` fingerprints, candidates are compared inside the row. Larger
buckets are exact too, without comparing pairs: each fingerprint is filed
under itself and all its one-bit neighbours within the table's free positions
(for a radius of 2); fingerprints filed under one key differ in at most two
bits, and every pair within two bits shares a key. Such a group has at most
one member per free position plus one.

Component ids come from ``components.smallest_reachable`` over the links.

Defined results: null and empty texts, and texts without a word, have
fingerprint zero and link like any other; fewer words than the shingle length
form one shingle; null ids are grouped by fingerprint but never are a
component id unless no other exists; repeated rows share fingerprint and
component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import cut, map_arrow, with_row_key, without_keys, worker_cache
from tidewater.llm.components import smallest_reachable

by_value(__name__)

RADIUS = 2
SHINGLE = 3
BUCKET_LIMIT = 64
BLOCK = 1 << 16
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text. Hashes are counted in blocks, so
    memory beside the text and its words does not grow with the shingles."""
    import numpy as np
    import xxhash

    words = _WORDS.findall((text or "").encode("utf-8").lower())   # bytes.lower: A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest, n = xxhash.xxh64_intdigest, len(starts)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, BLOCK):
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[lo:lo + BLOCK], ends[lo:lo + BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp as a signed long with the fingerprint's bits."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("simhash")                          # let go of other operators' tables
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, fp long")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks of the kept positions, one per table. Position i has the vector
    ``1 + i mod (2 ** (radius + 1) - 1)``."""
    tables = (1 << (radius + 1)) - 1
    vector = [1 + i % tables for i in range(bits)]
    return [sum(1 << i for i in range(bits) if bin(vector[i] & v).count("1") % 2) for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_in_bucket(radius: int):
    """Links among the (at most ``bucket_limit``) fingerprints of each bucket."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            left, right = [], []
            for row in batch.column(0):
                fp = np.sort(np.array(row.values.to_numpy(zero_copy_only=False), np.int64))
                gap = np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64))
                i, j = np.nonzero(np.triu(gap <= radius, 1))
                left.append(fp[i])
                right.append(fp[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left or [np.zeros(0, np.int64)])),
                                              pa.array(np.concatenate(right or [np.zeros(0, np.int64)]))],
                                             names=["a", "b"])

    return run


def close_links(prints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` such that the
    components of the links are those of all pairs within ``radius`` bits."""
    if radius != 2:
        raise ValueError("large buckets are resolved exactly for a radius of two bits only")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for i, m in enumerate(masks)])
    filed = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = filed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = cut(sizes)
    # both sides of this join are plain exchanges, so a hot bucket is split by adaptive execution
    shared = cut(filed.join(sizes.hint("merge"), ["t", "key"]))
    rows = shared.filter(F.col("n") <= bucket_limit).groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    links = map_arrow(rows, close_in_bucket(radius), "a long, b long")
    free = F.element_at(F.array(*[F.array(*[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1])
                                  for m in masks]), F.col("t") + 1)
    near = F.concat(F.array(F.lit(0).cast("long")), free)
    balls = (shared.filter(F.col("n") > bucket_limit).select("fp", "t", F.explode(near).alias("flip"))
             .select("fp", "t", F.col("fp").bitwiseXOR(F.col("flip")).alias("key")))
    hubs = (balls.groupBy("t", "key").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
            .select("a", F.explode("fps").alias("b")).filter("a < b"))
    links = links.unionByName(hubs)
    return links.distinct()


def _component_firsts(rows: DataFrame, first, radius: int, bucket_limit: int) -> DataFrame:
    """(fp, first): the smallest ``first`` of the component of each fingerprint."""
    prints = cut(rows.groupBy("fp").agg(F.min(first).alias("first")))
    links = close_links(prints, radius, bucket_limit)
    roots = smallest_reachable(links)                       # (node, root) of linked fingerprints only
    named = cut(prints.join(roots, prints["fp"] == roots["node"], "left")
                .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    firsts = cut(named.groupBy("root").agg(F.min("first").alias("first")))
    # one component may hold most fingerprints, one fingerprint most rows: plain joins, split when skewed
    return cut(named.select("fp", "root").join(firsts.hint("merge"), "root").select("fp", "first"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per input row: doc_id, fp, component_id."""
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    by_print = _component_firsts(rows, F.col("doc_id"), radius, bucket_limit)
    return rows.join(by_print.hint("merge"), "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """The input's columns, exactly one row of each component: the smallest id,
    null ids last, of equal ids the first row.

    Rows are told apart by a row key, not by their ids; only the keys to be
    dropped are joined to the texts."""
    keyed, key = with_row_key(docs)
    ids = keyed.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(key).alias("key"))
                       .alias("place"), F.col(text_col).alias("text"))
    rows = cut(fingerprints(ids, "place", "text", shingle).withColumnRenamed("doc_id", "place"))
    firsts = _component_firsts(rows, F.col("place"), radius, BUCKET_LIMIT)
    drop = cut(rows.join(firsts.hint("merge"), "fp").filter(F.col("place.key") != F.col("first.key"))
               .select(F.col("place.key").alias(key)))
    return without_keys(keyed, key, drop).select(*[f"`{c}`" for c in docs.columns])
