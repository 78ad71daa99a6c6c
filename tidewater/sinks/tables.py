"""A stored observation table (K5, K7, K8, X1, X2): parquet, by period and bucket.

Rows are laid out by the year of their time and a hash bucket of their datastream
key; the key itself stays a column and decides what is replaced, so two keys never
share a fate. The number of buckets is fixed, whatever the number of datastreams or
batches. Writes are rebalanced (``REBALANCE``): adaptive execution gives a folder as
many tasks and files as its rows need, so a datastream with a third of all rows is
written by many tasks, and small folders share one.

A micro-batch is held against the stored rows of its own years and buckets only.
``compact`` joins the small files that many micro-batches leave. A rewrite touches
only the folders of the keys concerned: their surviving rows and the new ones are
first materialised in the shared checkpoint folder and then replace those folders
(dynamic partition overwrite), so no plan reads what it overwrites and a lost
executor loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedup import keep_first
from tidewater.operators.joins import bounded_broadcast
from tidewater.session import cut, empty

BUCKET, PERIOD = "key_bucket", "period"
LAYOUT = [PERIOD, BUCKET]


class ObservationTable:
    """``schema``: the table's columns; ``key``: the datastream column; ``time``:
    the time as ISO text or timestamp (a table without that column, or a row
    without a time, has the period ``none``)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "datastream_key",
                 buckets: int = 64, time: str = "phenomenon_time"):
        self.spark, self.path, self.schema, self.key, self.buckets, self.time = spark, path, schema, key, buckets, time

    def _folder(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _placed(self, rows: DataFrame) -> DataFrame:
        named = rows.select(*self.schema.fieldNames())
        year = F.substring(F.col(self.time).cast("string"), 1, 4) if self.time in named.columns else F.lit(None).cast("string")
        return (named.withColumn(PERIOD, F.coalesce(F.when(year.rlike("^[0-9]{4}$"), year), F.lit("none")))
                .withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")))

    def _write(self, placed: DataFrame, mode: str) -> None:
        (placed.hint("rebalance", *LAYOUT).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(*LAYOUT).parquet(self.path))

    def _stored(self) -> DataFrame:
        """All rows with their place. What counts is the data itself: marker
        files are never consulted, and a missing folder is an empty table."""
        schema = T.StructType([*self.schema.fields, T.StructField(PERIOD, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        p, fs = self._folder(self.path)
        if not fs.exists(p):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(*LAYOUT)

    def held_for(self, placed: DataFrame) -> DataFrame:
        """The stored rows in the years and buckets of ``placed``; the lists prune
        the table's folders and are bounded by years and buckets."""
        places = placed.select(*LAYOUT).distinct().collect()
        if not places:
            return self._stored().filter(F.lit(False))
        return self._stored().filter(F.col(PERIOD).isin(sorted({r[0] for r in places}))
                                     & F.col(BUCKET).isin(sorted({r[1] for r in places})))

    def append(self, rows: DataFrame) -> None:
        """K8 NONE: add everything."""
        self._write(self._placed(rows), "append")

    def append_new(self, rows: DataFrame, identity: list[str], order: list[str] | None = None) -> None:
        """K5 / K8 DETERMINISTIC_ID: add the rows whose identity is not stored
        yet; of several with one identity the first in ``order``. Identity is a
        natural key (datastream key, time), never a hashed id alone; if it leaves
        out the key or the time, all folders are searched."""
        first = keep_first(rows, identity, order or identity)
        new = cut(self._placed(first))
        place = [c for c, of in ((PERIOD, self.time), (BUCKET, self.key)) if of in identity]
        held = self.held_for(new) if len(place) == 2 else self._stored()
        self._write(new.join(held.select(*identity, *place), [*identity, *place], "left_anti"), "append")

    def replace(self, rows: DataFrame) -> None:
        """K8 DELETE_BEFORE_UPLOAD: the stored rows of every datastream that
        ``rows`` touch give way to ``rows``."""
        new = cut(self._placed(rows))
        self._swap(new.select(self.key, BUCKET).distinct(), new)

    def delete(self, keys: DataFrame) -> None:
        """Remove all rows of the given datastreams."""
        named = keys.select(self.key).distinct()
        self._swap(named.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")), None)

    def _swap(self, keys: DataFrame, new: DataFrame | None) -> None:
        keys = cut(keys)
        touched = sorted(r[0] for r in keys.select(BUCKET).distinct().collect())          # at most ``buckets``
        held = self._stored().filter(F.col(BUCKET).isin(touched) if touched else F.lit(False))
        before = {(r[0], r[1]) for r in held.select(*LAYOUT).distinct().collect()}        # years times buckets
        left = held.join(bounded_broadcast(keys), [self.key, BUCKET], "left_anti").select(*self.schema.fieldNames(), *LAYOUT)
        rows = cut(left if new is None else left.unionByName(new))
        self._write(rows, "overwrite")
        full = {(r[0], r[1]) for r in rows.select(*LAYOUT).distinct().collect()}
        for period, bucket in before - full:             # a dynamic overwrite leaves emptied folders alone
            p, fs = self._folder(f"{self.path}/{PERIOD}={period}/{BUCKET}={bucket}")
            fs.delete(p, True)

    def compact(self, files_a_folder: int = 8) -> int:
        """Rewrite the folders that have more files; returns how many."""
        from tidewater.sources.hadoop import list_files

        place = [F.regexp_extract("name", f"{PERIOD}=([^/]+)/", 1).alias(PERIOD), F.regexp_extract("name", f"{BUCKET}=([0-9]+)/", 1).cast("int").alias(BUCKET)]
        files = list_files(self.spark, self.path, "*.parquet").groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
        many = cut(files.filter(F.col("n") > files_a_folder).select(*LAYOUT))
        n = many.count()
        if n:
            self._write(cut(self.held_for(many).join(bounded_broadcast(many), LAYOUT, "left_semi")), "overwrite")
        return n

    def clear(self) -> None:
        """An empty collection."""
        p, fs = self._folder(self.path)
        fs.delete(p, True)

    def load(self, rows: DataFrame, label: str = "observations") -> int:
        """K7 + K9: append ``rows`` and check the write -- the rows visible now,
        less those visible before, must not be fewer than were sent, for every
        datastream. Returns the number of rows added."""
        count = lambda df, name: df.groupBy(self.key).agg(F.count(F.lit(1)).alias(name))
        rows = cut(rows.select(*self.schema.fieldNames()))
        before = cut(count(self.read(), "before"))
        self.append(rows)
        report = (count(rows, "sent").join(count(self.read(), "visible"), self.key, "left")
                  .join(before, self.key, "left").fillna(0, ["visible", "before"]))
        bad = report.filter(F.col("visible") - F.col("before") < F.col("sent")).limit(5).collect()
        if bad:
            raise AssertionError(f"{label}: rows missing after write, e.g. {[r.asDict() for r in bad]}")
        return report.agg(F.coalesce(F.sum("sent"), F.lit(0))).first()[0]
