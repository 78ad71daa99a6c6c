"""Helpers shared by the operators of this package."""

from __future__ import annotations

import itertools
import sys
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.session import checkpoint_dir, cut  # noqa: F401

by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written once to shared storage with a number of its own in every
    row, and the name of that column. Ids may be null or repeat; the number
    stands for one row however often the table is read."""
    name = "row_key"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    folder = shared_folder(docs.sparkSession, "keyed-rows")
    docs.withColumn(name, F.monotonically_increasing_id()).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder), name


#: Bits of the filter that spares most rows a shuffle; its table has 1 / 64 as many rows.
FILTER_BITS = 1 << 24


def parted(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (key not null) in two: those whose key is surely not in ``keys``, and
    the others, which alone have to be shuffled to meet ``keys``. Told apart by a
    bitmap of fixed size of the keys' hashes, broadcast as a table; with more keys
    than bits it fills, and all rows are in the second part."""
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("bit")
    words = cut(keys.select(bit).groupBy(F.shiftright("bit", 6).alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), bit)
    marked = (whole.withColumn("word", F.shiftright("bit", 6))
              .join(F.broadcast(words), "word", "left"))                # at most FILTER_BITS / 64 rows
    hit = F.expr("coalesce(bits, 0L) & shiftleft(1L, cast(bit & 63 as int))") != 0
    return marked.filter(~hit).select("row.*"), marked.filter(hit).select("row.*")


def without_keys(rows: DataFrame, key: str, bad: DataFrame) -> DataFrame:
    """``rows`` (key not null) less those whose key is in ``bad``."""
    clean, doubtful = parted(rows, key, bad)
    return clean.unionByName(doubtful.join(bad, key, "left_anti").select(*[f"`{c}`" for c in rows.columns]))


#: Rows and bytes of an Arrow batch: a task holds a few batches beside its caches.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def map_arrow(df: DataFrame, fn: Callable[..., Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with the task function shipped by value and, for the
    session, Arrow batches of bounded size."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    by_value(fn.__module__ if fn.__module__ in sys.modules else __name__)
    return df.mapInArrow(fn, schema)


def slices(texts: list, max_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` with at most ``max_chars`` characters each (a
    longer text stands alone): bounds what a task holds beside its batch."""
    lo = n = 0
    for i, t in enumerate(texts):
        k = len(t) if t else 0
        if n and n + k > max_chars:
            yield lo, i
            lo, n = i, 0
        n += k
    if lo < len(texts):
        yield lo, len(texts)


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker (functions shipped
    by value get fresh module globals in every task). A worker keeps the cache
    of one operator at a time, so the stages of a pipeline do not add up."""
    name = "tidewater_worker_cache"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("held", {})
    if owner not in held:
        held.clear()
        held[owner] = {}
    return held[owner]


class _Codes(dict):
    """Numbers words in the order of their first sight."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word):
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


class WordTable:
    """One row of numbers for every distinct word, worked out when a word is
    first seen. Emptied beyond ``limit`` words, so its memory is bounded; the
    row of a word never depends on what is in the table."""

    def __init__(self, rows_of: Callable, limit: int = 300_000):
        self.rows_of, self.limit = rows_of, limit
        self.codes, self.rows = _Codes(), None

    def lookup(self, words: list[str]):
        """Row numbers of the words; rows are in ``self.rows``."""
        import numpy as np

        if len(self.codes) > self.limit:
            self.codes, self.rows = _Codes(), None
        out = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if fresh := self.codes.fresh:
            rows, self.codes.fresh = self.rows_of(fresh), []
            have = len(self.codes) - len(fresh)
            if self.rows is None or len(self.rows) < len(self.codes):
                grown = np.zeros((max(2 * len(self.codes), 4096), *rows.shape[1:]), rows.dtype)
                if have:
                    grown[:have] = self.rows[:have]
                self.rows = grown
            self.rows[have:len(self.codes)] = rows
        return out


def flatten(lists: list) -> list:
    return list(itertools.chain.from_iterable(lists))


def bitmap(bits: DataFrame, size: int):
    """A bitmap of ``size`` bits with the bits of the column ``bit`` set, or-ed
    together in Spark. The driver gets one packed row per partition, ``size / 64``
    words at most in all."""
    import numpy as np

    def pack(batches):
        import pyarrow as pa

        where, words = [], []
        for batch in batches:
            where.append(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"))
            words.append(batch.column(1).to_numpy(zero_copy_only=False).astype("<i8"))
        yield pa.RecordBatch.from_pydict({"w": pa.array([b"".join(x.tobytes() for x in where)], pa.binary()),
                                          "b": pa.array([b"".join(x.tobytes() for x in words)], pa.binary())})

    words = (bits.select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(size // 64, np.uint64)
    for w, b in map_arrow(words, pack, "w binary, b binary").collect():
        out[np.frombuffer(w, "<i8")] = np.frombuffer(b, "<i8").view(np.uint64)
    return out


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, mod ``k`` (null ids fall in fold 0)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % F.lit(k), F.lit(0))


def at_most(rows: DataFrame, label: str, per_label: int, *by: str) -> DataFrame:
    """At most ``per_label`` rows of every label, in an order drawn by a hash of
    ``by``; tasks pass on no more than that before the shuffle."""
    order = Window.partitionBy(label).orderBy(F.xxhash64(*by, F.lit("order")), *by)
    return rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= per_label).drop("_nth")


def draw(rows: DataFrame, label: str, id_col: str, per_label: int) -> Column:
    """Condition that draws about ``per_label`` rows of every label value, by a
    hash of the id at the rate ``per_label / rows of the label``: the expected
    size of the sample does not grow with the table. One small aggregate.
    Repeated ids are drawn together: ``at_most`` bounds what they add."""
    counts = {r[0]: r[1] for r in rows.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    unit = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30))
    drawn = F.lit(False)
    for value, n in sorted(counts.items(), key=str):
        drawn = drawn | ((F.col(label) == F.lit(value)) & (unit < F.lit(-(-per_label * (1 << 30) // n))))
    return F.col(id_col).isNotNull() & drawn


#: Longer texts are not drawn for training, which bounds a sample's bytes.
TRAINING_BYTES = 65_536


def training_texts(rows: DataFrame, text: str) -> DataFrame:
    return rows.filter(F.col(text).isNotNull() & (F.octet_length(text) <= TRAINING_BYTES))
