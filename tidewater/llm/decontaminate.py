"""Benchmark decontamination with spaced seeds (operator 1).

Words are lower-cased runs of letters and digits, each hashed to 64 bits. A
spaced seed is a fixed mask over a window of word positions; positions where
the mask has ``.`` are ignored, so a window still matches when words there were
replaced. Every window of every benchmark item and of every document is hashed
under each mask. The masks miss nothing that the verification accepts: every
stretch it can accept in an item of any length holds a window of one of them
(items of up to eight words have masks of their own beside the others).

* The benchmark's hashes set bits of a bitmap of fixed size (``BITMAP`` bits,
  two probes per hash), built by a distributed ``bit_or`` and broadcast: its
  size does not depend on either table. Document windows that miss it cannot
  match and never leave their task.
* Windows that pass are joined with the benchmark's hashes (a shuffle join)
  and give (document, item, diagonal) candidates, one per diagonal.
* Each candidate is verified: along its diagonal the document's words, sent
  along with the surrounding window, are compared with the item's. The best
  stretch (match +1, other -``PENALTY``) must have ``MIN_MATCH`` equal words, or
  ``SHORT_SHARE`` of a shorter item's words.

Defined results: null and empty texts and items have no windows and no
overlap; items of fewer than ``MIN_ITEM`` words are not looked for; null ids
are carried; repeated rows are reported once per (id, item); empty tables give
no overlaps; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import cut, flatten, map_arrow, slices, with_row_key, without_keys, worker_cache

by_value(__name__)

# Seeds over word positions: # compared, . ignored. The tests walk all patterns of equal and
# other words that ``verify`` accepts; change the masks only together with its limits.
MASKS = ("###.###", "##.#..###", "##.#.##..#", "####...#.#", "####.#..#")
#: Further masks for items of so many words.
SHORT_MASKS = {5: ("#####",), 6: ("#####", "##.###"), 7: ("##.###",), 8: ("##.####",)}
BITMAP = 1 << 26
MIN_MATCH = 12
PENALTY = 2
SHORT_SHARE = 0.8
MIN_ITEM = 5
REACH = 128
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def window_hashes(ids, mask: str):
    """64-bit hash of every window of ``ids`` under the mask (numpy uint64)."""
    import numpy as np

    n = len(ids) - len(mask) + 1
    out = np.full(max(n, 0), len(mask) * 0x9E37 + sum(1 << i for i, c in enumerate(mask) if c == "#"), np.uint64)
    if n <= 0:
        return out
    for i, c in enumerate(mask):
        if c == "#":
            out = (out ^ ids[i:i + n]) * np.uint64(0x9DDFEA08EB382D69)
            out ^= out >> np.uint64(29)
    return out


class WordHashes(dict):
    """64-bit hash of every word seen, emptied when it gets large."""

    def __missing__(self, word):
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_ids(words: list[str], memo: WordHashes):
    import numpy as np

    if len(memo) > 200_000:
        memo.clear()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def probes(h):
    """Two bit positions of a hash in the bitmap."""
    import numpy as np

    return h & np.uint64(BITMAP - 1), (h >> np.uint64(32)) & np.uint64(BITMAP - 1)


def seed_windows(items: DataFrame) -> DataFrame:
    """(item, pos, h): every spaced-seed window of the benchmark's items."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            item, pos, hashes = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = word_ids(words_of(t), WordHashes())
                for mask in (*MASKS, *SHORT_MASKS.get(len(ids), ())):
                    h = window_hashes(ids, mask)
                    item += [i] * len(h)
                    pos += range(len(h))
                    hashes.append(h)
            h = np.concatenate(hashes or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(item, batch.column(0).type), pa.array(pos, pa.int32()),
                                              pa.array(h.view(np.int64))], names=["item", "pos", "h"])

    kind = items.schema["item"].dataType.simpleString()
    return map_arrow(items, run, f"item {kind}, pos int, h long")


def bitmap_of(seeds: DataFrame):
    """The fixed-size bitmap of all seed hashes, or-ed together in Spark; what
    reaches the driver are its ``BITMAP / 64`` words at most."""
    import numpy as np

    bit = F.explode(F.array(F.col("h").bitwiseAND(F.lit(BITMAP - 1)),
                            F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(BITMAP - 1))))
    words = (seeds.select(bit.alias("bit"))
             .select(F.shiftright("bit", 6).alias("w"),
                     F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas())
    bits = np.zeros(BITMAP // 64, np.uint64)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return bits


def scan(shared, short):
    """Document windows that pass the bitmap, merged to runs of hits no more than
    ``REACH`` words apart: (run, doc, at, window word ids, hit positions, hit
    hashes). ``short``: the masks of the short items that there are."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bits, memo = shared.value, worker_cache("decontaminate").setdefault("words", WordHashes())
        masks = (*MASKS, *short)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out: dict[str, list] = {k: [] for k in ("row", "at", "ids", "pos", "h")}
            for lo, hi in slices(texts):
                docs = [words_of(t) for t in texts[lo:hi]]
                sizes = np.array([len(d) for d in docs], np.int64)
                ends = np.cumsum(sizes)
                ids = word_ids(flatten(docs), memo)
                found_pos, found_h = [], []
                for mask in masks:
                    h = window_hashes(ids, mask)
                    one, two = probes(h)
                    pos = np.flatnonzero((bits[one >> np.uint64(6)] >> (one & np.uint64(63))
                                          & bits[two >> np.uint64(6)] >> (two & np.uint64(63)) & np.uint64(1)))
                    doc = np.searchsorted(ends, pos, "right")
                    inside = pos + len(mask) <= ends[doc] if len(pos) else np.zeros(0, bool)
                    found_pos.append(pos[inside])
                    found_h.append(h[pos[inside]])
                pos, h = np.concatenate(found_pos), np.concatenate(found_h)
                if not len(pos):
                    continue
                order = np.argsort(pos, kind="stable")
                pos, h = pos[order], h[order]
                doc = np.searchsorted(ends, pos, "right")
                new = np.flatnonzero(np.append(True, (np.diff(doc) > 0) | (np.diff(pos) > REACH)))
                for a, b in zip(new, np.append(new[1:], len(pos))):
                    d = doc[a]
                    first = max(ends[d] - sizes[d], pos[a] - REACH)
                    last = min(ends[d], pos[b - 1] + REACH)
                    out["row"].append(lo + int(d))
                    out["at"].append(int(first - (ends[d] - sizes[d])))
                    out["ids"].append(ids[first:last].astype("<u8").tobytes())
                    out["pos"].append((pos[a:b] - first).astype(np.int32))
                    out["h"].append(h[a:b].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["at"], pa.int64()),
                 pa.array(out["ids"], pa.binary()), pa.array(out["pos"], pa.list_(pa.int32())),
                 pa.array(out["h"], pa.list_(pa.int64()))], names=["doc_id", "at", "ids", "pos", "h"])

    return run


def best_stretch(equal):
    """(matched, length, start) of the stretch with the highest score, match +1
    and other -``PENALTY``."""
    import numpy as np

    gain = np.where(equal, 1, -PENALTY)
    total = np.concatenate([[0], np.cumsum(gain)])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[:end + 1]))
    return int(equal[start:end].sum()), end - start, start


def verify(batches):
    """Compare the words of a run beside an item with the item's from ``skip`` on."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        c = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if i >= 2}
        keep, matched, length, at = [], [], [], []
        for i, (ids, words, skip, first) in enumerate(zip(c["ids"], c["words"], c["skip"], c["at"])):
            x, y = np.frombuffer(ids, "<u8"), np.frombuffer(words, "<u8")
            if not len(x):
                continue
            m, n, s = best_stretch(x == y[skip:skip + len(x)])
            if m >= MIN_MATCH or len(y) < MIN_MATCH / SHORT_SHARE and m >= max(MIN_ITEM, SHORT_SHARE * len(y)):
                keep.append(i)
                matched.append(m)
                length.append(n)
                at.append(first + s)
        take = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(at, pa.int64()),
             pa.array(length, pa.int64()), pa.array(matched, pa.int64())],
            names=["doc_id", "item_id", "first_word", "n_words", "n_equal"])


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal): the best verified overlap
    of every contaminated (document, item) pair."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    items = cut(items.withColumn("nth", F.monotonically_increasing_id()))
    seeds = cut(seed_windows(items.select(F.col("nth").alias("item"), "text")))
    item_words = cut(map_arrow(items.select("nth", "item", "text"), encode_items,
                               f"nth long, item {items.schema['item'].dataType.simpleString()}, words binary"))
    lengths = [r[0] for r in item_words.select((F.octet_length("words") / 8).cast("int").alias("n")).distinct()
               .filter(F.col("n").isin(*SHORT_MASKS)).collect()]                   # at most four values
    short = sorted({m for n in lengths for m in SHORT_MASKS[n]})
    shared = spark.sparkContext.broadcast(bitmap_of(seeds))                        # fixed size
    kind = source.schema["doc_id"].dataType.simpleString()
    runs = cut(map_arrow(source, scan(shared, short),
                         f"doc_id {kind}, at long, ids binary, pos array<int>, h array<long>")
               .withColumn("run", F.monotonically_increasing_id()))
    hits = runs.select("run", F.explode(F.arrays_zip("pos", "h")).alias("x")).select("run", "x.pos", "x.h")
    pairs = (hits.join(seeds.withColumnRenamed("pos", "item_pos"), "h")
             .groupBy("run", "item").agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("diags"))
             .select("run", F.col("item").alias("nth"), F.explode("diags").alias("diag")))
    # of the run only the words beside the item go on, so candidates grow with the items and not with the runs
    begin = F.greatest(F.col("diag").cast("long"), F.lit(0).cast("long"))
    beside = F.least(F.octet_length("ids"), 8 * (F.col("diag") + F.octet_length("words") / 8).cast("long")) - 8 * begin
    full = (pairs.join(item_words, "nth").join(runs.select("run", "doc_id", "at", "ids"), "run")
            .select("doc_id", "item", (F.col("at") + begin).alias("at"), F.substr("ids", (8 * begin + 1).cast("int"), beside.cast("int")).alias("ids"),
                    "words", (begin - F.col("diag")).alias("skip")))
    item_kind = items.schema["item"].dataType.simpleString()
    found = map_arrow(full, verify, f"doc_id {kind}, item_id {item_kind}, first_word long, n_words long, n_equal long")
    best = F.max(F.struct("n_equal", -F.col("n_words"), -F.col("first_word")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("x"))
            .select("doc_id", "item_id", (-F.col("x.col3")).alias("first_word"), (-F.col("x.col2")).alias("n_words"),
                    F.col("x.n_equal").alias("n_equal")))


def encode_items(batches):
    import pyarrow as pa

    for batch in batches:
        words = [word_ids(words_of(t), WordHashes()).astype("<u8").tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.binary())],
                                         names=["nth", "item", "words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **items) -> DataFrame:
    """The input's rows and columns without the rows whose text overlaps an item.

    Rows are told apart by a row key, not by their ids, which may be null or repeat."""
    keyed, key = with_row_key(docs)
    bad = cut(overlaps(keyed, benchmark, key, text_col, **items).select(F.col("doc_id").alias(key)).distinct())
    return without_keys(keyed, key, bad).select(*[f"`{c}`" for c in docs.columns])
