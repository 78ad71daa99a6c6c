"""Byte-level BPE by overlapping chunk encoding (operator 8).

Long texts are cut into chunks of ``CHUNK`` characters with ``OVERLAP`` more on
the right, so their pieces can be found by many tasks.

1. Pre-tokenise: every chunk is split on its own with the tokenizer's pattern.
   The pattern looks ahead but never back, so where two splits share one piece
   start they agree from there on. A chunk reports its piece starts inside its
   head (the overlap with the chunk before) and its tail; starts whose piece
   ends within two characters of the window's end are not settled and left out.
2. Stitch: chunk k takes over at the first start that the tail of chunk k - 1
   and its own head share. Only these short lists meet, per document.
3. Encode: every chunk pre-tokenises its window and encodes the pieces that
   start between its own take-over point and the next chunk's, so that a piece
   always sees the text behind it; the parts are put together in order.

If some overlap has no shared start (one piece longer than the overlap) the
document is encoded whole, as one chunk: exact, only less parallel. Texts of up
to one chunk have nothing to stitch and are encoded in place.

Decoding concatenates the bytes of the ids. Segments between spaces are encoded
once per worker and kept in a memo that is emptied at ``MEMO`` entries.

Defined results: null texts count as empty; empty texts have no ids; null ids
and repeated rows are encoded like any other; lone surrogates cannot occur in
Spark strings; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import cut, map_arrow, shared_folder, worker_cache

by_value(__name__)

CHUNK = 16_384
OVERLAP = 1_024
MEMO = 180_000
LONGEST = 64
ROW_GROUP = 8 << 20
MARGIN = 2


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Encoded(dict):
    """Comma-joined ids of text segments; None marks a segment that may not
    stand alone (see ``Codec.encode_text``)."""

    def __init__(self, bpe, names: list[str], lead: str):
        super().__init__()
        self.bpe, self.names, self.lead = bpe, names, lead

    def __missing__(self, part):
        if self.lead and (not part or part[0].isspace()):
            got = None
        else:
            got = ",".join(map(self.names.__getitem__, self.bpe.encode_ordinary(self.lead + part)))
        self[part] = got
        return got


class _Pieces(dict):
    """Packed ids of single pieces."""

    def __init__(self, bpe, kind: str):
        super().__init__()
        self.bpe, self.kind = bpe, kind

    def encoded(self, piece: str) -> bytes:
        import numpy as np

        return np.array(self.bpe._encode_single_piece(piece.encode()), self.kind).tobytes()

    def __missing__(self, piece):
        got = self[piece] = self.encoded(piece)
        return got


class _Decoded(dict):
    """Bytes of comma-joined ids."""

    def __init__(self, table: list[bytes]):
        super().__init__()
        self.table = table

    def __missing__(self, ids):
        got = self[ids] = b"".join([self.table[int(i)] for i in ids.split(",")]) if ids else b""
        return got


class Codec:
    """Encoder and decoder of one vocabulary inside a task."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        ranks = load_ranks(ranks_path)
        self.bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.table = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.table[i] = b
        self.names = [str(i) for i in range(len(self.table))]
        self.kind = "<u2" if len(self.table) <= 1 << 16 else "<u4"
        self.forget()

    def forget(self):
        self.first, self.rest = _Encoded(self.bpe, self.names, ""), _Encoded(self.bpe, self.names, " ")
        self.decoded = _Decoded(self.table)
        self.pieces = _Pieces(self.bpe, self.kind)

    def encode_text(self, text: str) -> tuple[str, bytes]:
        """(comma-joined ids, decoded bytes) of a text.

        No piece holds a space after another character unless both are white
        space, so a text may be cut before every space that is followed by no
        white space; segments are encoded once and looked up from then on. A
        text with any other space is encoded as it stands."""
        if len(self.rest) + len(self.first) > MEMO:
            self.forget()
        head, *tail = text.split(" ")
        parts = [self.first[head] if len(head) <= LONGEST else self.plain(head)]
        parts += map(self.rest.__getitem__, tail)
        if None in parts:
            ids = self.plain(text)
            return ids, b"".join([self.table[int(i)] for i in ids.split(",")])
        return ",".join(filter(None, parts)), b"".join(map(self.decoded.__getitem__, parts))

    def encode_pieces(self, window: str, begin: int, end: int | None) -> bytes:
        """Packed ids of the pieces of a window that start in [begin, end);
        ``begin`` is a piece start."""
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        found = (m.group() for m in self.pattern.finditer(window, begin) if end is None or m.start() < end)
        return b"".join([self.pieces[x] if len(x) <= LONGEST else self.pieces.encoded(x) for x in found])

    def plain(self, text: str) -> str:
        return ",".join(map(self.names.__getitem__, self.bpe.encode_ordinary(text)))


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    cache = worker_cache("bpe")
    if (path, pattern) not in cache:
        cache[path, pattern] = Codec(path, pattern)
    return cache[path, pattern]


def piece_starts(pattern, window: str, complete: bool) -> list[int]:
    """Settled piece starts of a window. Unless the window ends with its text, a
    start counts only if its piece ends ``MARGIN`` characters before the end."""
    last = len(window) if complete else len(window) - MARGIN
    return [m.start() for m in pattern.finditer(window) if m.end() <= last]


def cut_chunks(chunk: int, overlap: int):
    """Rows (row, doc_id, text) to rows (row, doc_id, k, last, window)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                n = -(-len(text) // chunk)
                for lo in range(0, n, 256):
                    ks = range(lo, min(n, lo + 256))
                    own = pa.array([i] * len(ks), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(own), batch.column(1).take(own), pa.array(ks, pa.int32()),
                         pa.array([k == n - 1 for k in ks], pa.bool_()),
                         pa.array([text[k * chunk:(k + 1) * chunk + overlap] for k in ks], pa.string())],
                        names=["row", "doc_id", "k", "last", "window"])

    return run


def find_borders(path: str, pattern: str, chunk: int, overlap: int):
    """(row, k, last, head, tail): settled starts of both overlaps, as offsets
    from the overlap's first character."""

    def run(batches):
        import pyarrow as pa

        split = codec(path, pattern).pattern
        for batch in batches:
            heads, tails = [], []
            for k, last, window in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                starts = piece_starts(split, window, last)
                heads.append([s for s in starts if s < overlap] if k else [])
                tails.append([s - chunk for s in starts if s >= chunk])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(heads, pa.list_(pa.int32())),
                                              pa.array(tails, pa.list_(pa.int32()))],
                                             names=["row", "k", "last", "head", "tail"])

    return run


def encode_parts(path: str, pattern: str):
    """Encode the pieces of every window that start in [begin, end) (end null:
    all the rest); ids travel as packed unsigned integers."""

    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for batch in batches:
            got = [own.encode_pieces(w, a, b) for w, a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.binary())],
                                             names=["row", "k", "ids"])

    return run


def result(ids: str, raw: bytes, with_parts: bool) -> tuple:
    """(number of ids, ids, bytes), the latter two as digests unless ``with_parts``."""
    import hashlib

    n = ids.count(",") + 1 if ids else 0
    return (n, ids, raw) if with_parts else (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest())


def encode_whole(path: str, pattern: str, with_parts: bool):
    """Encode whole texts; rows (row, n_tokens, ids or digest, bytes or digest)."""

    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n, left, right = [], [], []
            for t in texts:
                a = result(*own.encode_text(t or ""), with_parts)
                n.append(a[0])
                left.append(a[1])
                right.append(a[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(left, pa.string()),
                 pa.array(right, pa.binary() if with_parts else pa.string())], names=["row", "n_tokens", "ids", "decoded"])

    return run


def join_parts(path: str, pattern: str, with_parts: bool):
    """The parts of one document, in order (bounded by the document itself)."""

    def run(pdf):
        import numpy as np
        import pandas as pd

        own = codec(path, pattern)
        pdf = pdf.sort_values("k")
        ids = np.frombuffer(b"".join(pdf["ids"]), own.kind).tolist()
        row = result(",".join(map(own.names.__getitem__, ids)), b"".join(map(own.table.__getitem__, ids)), with_parts)
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "n_tokens": [row[0]], "ids": [row[1]], "decoded": [row[2]]})

    return run


def whole_text(chunk: int):
    """The chunks of one document back as its text, one chunk 0."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("k")
        text = "".join(w if last else w[:chunk] for w, last in zip(pdf["window"], pdf["last"]))
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "k": [0], "window": [text], "begin": [0], "end": [None]})

    return run


def stitched_parts(chunks: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, k, window, begin, end) of every chunk; a text that does not
    resynchronise somewhere comes back as its one chunk 0."""
    borders = map_arrow(chunks.select("row", "k", "last", "window"), find_borders(path, pattern, chunk, overlap),
                        "row long, k int, last boolean, head array<int>, tail array<int>")
    by_doc = Window.partitionBy("row").orderBy("k")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(by_doc)))
    met = borders.withColumn("begin", F.when(F.col("k") == 0, 0).otherwise(shared)).select("row", "k", "begin")
    met = (met.withColumn("next", F.lead("begin").over(by_doc))
           .withColumn("bad", F.max(F.col("begin").isNull()).over(Window.partitionBy("row"))))
    met = cut(met)
    good = (chunks.join(met.filter("not bad"), ["row", "k"])
            .select("row", "k", "window", "begin", F.when(~F.col("last"), F.col("next") + chunk).alias("end")))
    whole = met.filter("bad").select("row").distinct()
    if not whole.limit(1).count():
        return good                                      # all texts resynchronise: their chunks are shuffled once
    rest = (chunks.join(whole, "row", "left_semi").select("row", "k", "last", "window").groupBy("row")
            .applyInPandas(whole_text(chunk), "row long, k int, window string, begin int, end int"))
    return good.unionByName(rest)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_parts: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: doc_id, n_tokens and either the digests
    ids_sha256, decoded_sha256 or (``with_parts``) the comma-joined ``ids`` and
    the ``decoded`` bytes themselves.

    ``ranks_path`` is a rank file that every executor can open. The chunks of
    long texts are kept as compressed Parquet in the shared folder, in small row
    groups, so that even one very long text is read by many tasks."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    value = "ids string, decoded binary" if with_parts else "ids string, decoded string"
    short = (map_arrow(source.filter(F.length("text") <= chunk), encode_whole(ranks_path, pattern, with_parts),
                       f"row {kind}, n_tokens long, {value}").withColumnRenamed("row", "doc_id"))
    # a row number keeps repeated and null ids apart
    long_rows = source.filter(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    folder = shared_folder(spark, "chunks")
    (map_arrow(long_rows, cut_chunks(chunk, overlap), f"row long, doc_id {kind}, k int, last boolean, window string")
     .write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(folder))
    chunks = spark.read.parquet(folder)
    parts = stitched_parts(chunks, ranks_path, pattern, chunk, overlap)
    encoded = map_arrow(parts, encode_parts(ranks_path, pattern), "row long, k int, ids binary")
    joined = encoded.groupBy("row").applyInPandas(join_parts(ranks_path, pattern, with_parts), f"row long, n_tokens long, {value}")
    ids_of_rows = chunks.filter("k = 0").select("row", "doc_id")
    out = short.unionByName(joined.join(ids_of_rows, "row").select(*short.columns))
    names = ("ids", "decoded") if with_parts else ("ids_sha256", "decoded_sha256")
    return out.select("doc_id", "n_tokens", F.col("ids").alias(names[0]), F.col("decoded").alias(names[1]))


def decode(ids: str, ranks_path: str, pattern: str) -> bytes:
    """Bytes of comma-joined ids."""
    table = codec(ranks_path, pattern).table
    return b"".join(table[int(i)] for i in ids.split(",") if i)
