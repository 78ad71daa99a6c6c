"""Token ids as length-delimited binary records (operator 5).

A data file is a sequence of frames, one per document:

    uint64 length | uint32 masked crc of those 8 bytes | payload | uint32 masked crc of the payload

all little-endian; the checksum is CRC-32, rotated right by 15 bits plus the
constant 0xA282EAD8, so that a checksum stored inside checksummed data stays
harmless. A payload is one header byte (the id width, 2 or 4 bytes) and the
ids. Beside each data file stands an offset index, ``.idx``: per frame the
document id (int64, with a null flag byte before it), the frame's offset and its
id count. A reader can thus fetch frames in any order (``read_shuffled``)
without scanning the data.

Writing: rows are range-partitioned by document id and sorted inside each
partition, so the files in name order hold ascending ids (nulls first, ties by
a hash of the text: the rows of one id may fill many files). Every task writes its own pair of files to a name private to the attempt
and renames both when complete; a lost executor's task writes them again. The
files go through Arrow's file systems, so the folder may be a local, HDFS or
S3 path that all executors share.

Encoding uses the tokenizers library. White space never belongs to a token of
these word-level vocabularies, so a text is split at ASCII blanks, each distinct
word is encoded once per worker, and the ids are laid together with numpy.

The strings of special tokens in a text become those tokens, as in the plain
library call.

Defined results: null and empty texts have only the end id; repeated rows are
written as often as they occur; an empty table writes no frames; other columns
are not read.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import cut, map_arrow, slices, worker_cache
from tidewater.sources.stores import file_system

by_value(__name__)

MASK = 0xA282EAD8
END_ID = 2
MEMO = 600_000
MARKS = ".,;:!?"
# Byte-level vocabularies write bytes that do not print as the characters from U+0100 on, in order.
BYTE_FORMS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
INDEX = "<?qQQ"                # null flag, document id, offset, id count


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(data, offset: int) -> tuple[bytes, int]:
    """Payload of the frame at ``offset`` and the offset of the next one."""
    head = bytes(data[offset:offset + 8])
    if len(head) < 8 or struct.unpack_from("<I", data, offset + 8)[0] != masked(head):
        raise ValueError(f"bad length checksum at {offset}")
    end = offset + 12 + struct.unpack("<Q", head)[0]
    payload = bytes(data[offset + 12:end])
    if len(data) < end + 4 or struct.unpack_from("<I", data, end)[0] != masked(payload):
        raise ValueError(f"bad payload checksum at {offset}")
    return payload, end + 4


def ids_of(payload: bytes):
    import numpy as np

    return np.frombuffer(payload, f"<u{payload[0]}", offset=1)


class _Codes(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class WordEncoder:
    """Ids of whole texts, each distinct word encoded once and kept.

    Beyond ``MEMO`` words the rarer ones are forgotten (what a word encodes to
    does not depend on the memo). A new word of Latin letters and at most one
    mark shares the entry of its letters: the tokenizer lower-cases, and the
    pre-tokenizer parts letters from marks. That holds only if the letters still
    end in a letter once normalised (the dotted capital I ends in a combining
    mark, which goes with the mark behind it); other words are encoded whole."""

    def __init__(self, path: str, end_id: int):
        import os

        import numpy as np
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks in parallel
        self.tokenizer = Tokenizer.from_file(path)
        rule = self.tokenizer.normalizer
        self.normal = rule.normalize_str if rule else str
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.codes = _Codes()
        self.codes[None] = 0                             # the end of a text
        self.pool, self.starts, self.lengths = np.array([end_id], f"<u{self.width}"), np.zeros(1, np.int64), np.ones(1, np.int64)
        self.seen = np.ones(1, np.int64)
        self.letters: dict[str, bytes] = {}
        self.marks = {m: self.pack(self.ids([m])[0]) for m in MARKS}

    def ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def forget(self):
        """Keep the half of ``MEMO`` words that were seen most."""
        import numpy as np

        keep = np.argsort(-self.seen[1:], kind="stable")[:MEMO // 2] + 1
        keep = np.concatenate([[0], np.sort(keep)])
        names = list(self.codes)
        self.codes = _Codes({names[i]: n for n, i in enumerate(keep.tolist())})
        lengths = self.lengths[keep]
        ends = np.cumsum(lengths)
        self.pool = self.pool[np.repeat(self.starts[keep] - (ends - lengths), lengths) + np.arange(ends[-1])]
        self.starts, self.lengths, self.seen, self.letters = ends - lengths, lengths, self.seen[keep], {}

    def learn(self, words: list[str]):
        """Add new words; ids are kept as bytes, which cost no garbage collection."""
        import numpy as np

        letters, marks, normal = self.letters, self.marks, self.normal
        cores, ends = [], []
        for w in words:
            end = marks.get(w[-1:], b"")
            core = w[:-1] if end else w
            if not core.isalpha():
                core, end = w, b""
            elif core.isascii() or max(core) < "\u0100":
                core = core.lower()
            elif end and (max(core) >= "\u0250" or not normal(core)[-1:].isalpha()):
                core, end = w, b""
            cores.append(core)
            ends.append(end)
        merge, pack = self.tokenizer.model.tokenize, self.pack
        rest = []
        for w in dict.fromkeys(cores):
            if w not in letters:
                if w.isalpha() and (w.isascii() or max(w) < "\u0100"):
                    # lower-case Latin letters are normal already; what is left are bytes and merges
                    form = w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_FORMS)
                    letters[w] = pack([t.id for t in merge(form)])
                else:
                    rest.append(w)
        letters.update(zip(rest, map(pack, self.ids(rest))))
        got = [letters[w] + end for w, end in zip(cores, ends)]
        lengths = np.fromiter(map(len, got), np.int64, len(got)) // self.width
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.seen = np.concatenate([self.seen, np.zeros(len(got), np.int64)])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(got), self.pool.dtype)])
        if len(letters) > MEMO:
            self.letters = {}

    def pack(self, ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(self.width, "little") for i in ids])

    def encode(self, texts: list) -> list:
        """One array of ids per text, with the end id."""
        import itertools

        import numpy as np

        if not texts:
            return []
        if len(self.codes) > MEMO:
            self.forget()
        words = [(t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") + [None] for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.fromiter(map(self.codes.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(sizes.sum()))
        if len(self.codes) > len(self.starts):
            self.learn(list(itertools.islice(self.codes, len(self.starts), None)))
        self.seen += np.bincount(word, minlength=len(self.seen))
        n = self.lengths[word]
        ends = np.cumsum(n)
        out = self.pool[np.repeat(self.starts[word] - (ends - n), n) + np.arange(ends[-1])]
        return np.split(out, ends[np.cumsum(sizes) - 1][:-1])


def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    cache = worker_cache("token records")
    if ("words", path, end_id) not in cache:
        cache["words", path, end_id] = WordEncoder(path, end_id)
    return cache["words", path, end_id]


def write_files(folder: str, tokenizer_path: str, end_id: int):
    """Task: write the partition's rows, already in order, to one pair of files;
    returns (file, frames, tokens)."""

    def run(batches):
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        store, root = file_system(folder)
        name = f"{root}/part-{TaskContext.get().partitionId():07d}"
        attempt = f"{root}/_attempt-{uuid.uuid4().hex}"
        own, frames, tokens, offset, out, index = encoder(tokenizer_path, end_id), 0, 0, 0, None, None
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                if out is None:
                    out, index = store.open_output_stream(attempt), store.open_output_stream(attempt + ".idx")
                for doc, ids in zip(docs[lo:hi], own.encode(texts[lo:hi])):
                    data = frame(bytes([own.width]) + np.ascontiguousarray(ids).tobytes())
                    out.write(data)
                    index.write(struct.pack(INDEX, doc is None, doc or 0, offset, len(ids)))
                    offset, frames, tokens = offset + len(data), frames + 1, tokens + len(ids)
        if out is not None:
            out.close()
            index.close()
            store.move(attempt, name + ".rec")
            store.move(attempt + ".idx", name + ".idx")
            yield pa.RecordBatch.from_pydict({"file": [name], "frames": [frames], "tokens": [tokens]})

    return run


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Write all rows below ``folder``; returns (file, frames, tokens, start):
    ``start`` counts the ids of all files before."""
    spark = docs.sparkSession
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    files = cut(map_arrow(rows, write_files(folder, tokenizer_path, end_id), "file string, frames long, tokens long"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)      # one small row per file
    return cut(files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))))


def read_index(store, name: str) -> list:
    with store.open_input_file(name + ".idx") as f:
        return list(struct.iter_unpack(INDEX, f.read()))


def read_files(folder: str):
    """Task: read the files named in its rows frame by frame, through their
    indexes; checks every frame."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        store, _ = file_system(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                entries = read_index(store, name)
                with store.open_input_file(name + ".rec") as f:
                    size = f.size()
                    for lo in range(0, len(entries), 4096):
                        part = entries[lo:lo + 4096]
                        rows = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                        for k, (null, doc, offset, n) in enumerate(part, lo):
                            end = entries[k + 1][2] if k + 1 < len(entries) else size
                            f.seek(offset)
                            ids = ids_of(unframe(f.read(end - offset), 0)[0])
                            if len(ids) != n:
                                raise ValueError(f"{name}: index and frame {k} differ")
                            rows["doc_id"].append(None if null else doc)
                            rows["start"].append(start)
                            rows["n_tokens"].append(n)
                            rows["ids_crc32"].append(zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()))
                            start += n
                        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows.values()],
                                                         names=list(rows))

    return run


def read_records(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, from the files."""
    files = files.select("file", "start")
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism * 2)
    return map_arrow(spread, read_files(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(spark: SparkSession, files: DataFrame, folder: str, seed: int, handles: int = 64) -> DataFrame:
    """(doc_id, ids) of all records in a seeded random order: the index entries
    are shuffled as rows of their own, then every task fetches its frames by
    offset, with at most ``handles`` files open."""

    def entries(batches):
        import pyarrow as pa

        store, _ = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = read_index(store, name)
                for lo in range(0, len(rows), 20_000):
                    part = rows[lo:lo + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part), pa.string()), pa.array([r[2] for r in part], pa.int64()),
                         pa.array([None if r[0] else r[1] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.int64())],
                        names=["file", "offset", "doc_id", "n"])

    def fetch(batches):
        import pyarrow as pa

        store, _ = file_system(folder)
        opened: dict = {}
        for batch in batches:
            ids = []
            for name, offset, n in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if name not in opened:
                    if len(opened) >= handles:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = store.open_input_file(name + ".rec")
                f = opened[name]
                f.seek(offset)
                head = f.read(12)
                got = ids_of(unframe(head + f.read(struct.unpack("<Q", head[:8])[0] + 4), 0)[0])
                if len(got) != n:
                    raise ValueError(f"{name}: index and frame at {offset} differ")
                ids.append(got.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    index = map_arrow(files.select("file"), entries, "file string, offset long, doc_id long, n long")
    order = index.orderBy(F.xxhash64("file", "offset", F.lit(seed)))
    return map_arrow(order, fetch, "doc_id long, ids array<long>")
