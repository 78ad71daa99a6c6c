"""Observation batches stored with a record of every batch (K9).

A load writes the rows of its batches below a folder of its own, counts what is
visible there per batch and file, and publishes one record per batch: label, batch
number, rows expected, rows inserted, file names. Rows count once their load is on
record, so a load that dies leaves nothing visible. A retried batch is on record
already and adds nothing; a batch that fell short is an error that names it.
``verify`` later holds storage against the records.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import cut, empty
from tidewater.sinks.generations import GenerationStore
from tidewater.sources.hadoop import Folders

LOAD = "load"


class BatchLog:
    """``label`` and ``batch`` are columns of ``schema`` that name a batch."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, label: str = "datastream_key", batch: str = "batch_no"):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.label, self.batch, self.keys = label, batch, [label, batch]
        self.store = GenerationStore(spark, f"{self.root}/log")

    def records(self) -> DataFrame:
        """label, batch, expected, inserted, load and files (name, rows)."""
        at = self.store.snapshot()
        if at.tables:
            return self.store.read("batches", at)
        keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields if f.name in self.keys)
        return empty(self.spark, f"{keys}, expected long, inserted long, {LOAD} string, "
                                              "files array<struct<name:string,rows:long>>")

    def _stored(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(LOAD, T.StringType())])
        if not Folders(self.spark).exists(f"{self.root}/rows"):
            return empty(self.spark, full)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows")

    def read(self) -> DataFrame:
        """The rows of all loads on record."""
        loads = [r[0] for r in self.records().select(LOAD).distinct().collect()]      # one per load
        return self._stored().filter(F.col(LOAD).isin(loads) if loads else F.lit(False)).drop(LOAD)

    def _counted(self, stored: DataFrame) -> DataFrame:
        """(label, batch, load, visible, files) of stored rows."""
        per_file = (stored.withColumn("name", F.col("_metadata.file_name")).groupBy(*self.keys, LOAD, "name")
                    .agg(F.count(F.lit(1)).alias("rows")))
        return per_file.groupBy(*self.keys, LOAD).agg(F.sum("rows").alias("visible"),
                                                      F.sort_array(F.collect_list(F.struct("name", "rows"))).alias("files"))

    def load(self, rows: DataFrame) -> DataFrame:
        """Store the batches that are not on record yet; returns their records.
        A short batch raises with label, batch, inserted and expected."""
        base = self.store.snapshot()
        rows = rows.select(*self.schema.fieldNames()).join(self.records().select(*self.keys), self.keys, "left_anti")
        expected = cut(rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("expected")))
        load = uuid.uuid4().hex
        folder = f"{self.root}/rows/{LOAD}={load}"
        rows.repartition(*self.keys).write.parquet(folder)                            # a batch is bounded; labels spread by batch
        stored = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/rows").parquet(folder)
        found = cut(expected.join(self._counted(stored.withColumn(LOAD, F.lit(load))), self.keys, "left")
                    .select(*self.keys, "expected", F.coalesce("visible", F.lit(0)).alias("inserted"), F.lit(load).alias(LOAD), "files"))
        short = found.filter(F.col("inserted") < F.col("expected")).limit(5).collect()
        if short:
            raise AssertionError("batches short after write: " + "; ".join(
                f"{r[self.label]} batch {r[self.batch]}: inserted {r['inserted']}, expected {r['expected']}" for r in short))
        self.store.commit({"batches": self.records().unionByName(found)}, base)
        return found

    def verify(self) -> DataFrame:
        """label, batch, expected, inserted (rows visible now), status (``ok``,
        ``lost`` or ``doubled``), files missing and files not on record."""
        records = self.records()
        if Folders(self.spark).exists(f"{self.root}/rows"):
            now = self._counted(self._stored()).withColumnRenamed("files", "files_now")
        else:
            now = records.select(*self.keys, LOAD, F.col("expected").alias("visible"), F.col("files").alias("files_now")).limit(0)
        j = records.join(now, [*self.keys, LOAD], "left")
        inserted = F.coalesce("visible", F.lit(0).cast("long"))
        names = lambda c: F.coalesce(F.transform(c, lambda f: f["name"]), F.array().cast("array<string>"))
        return j.select(*self.keys, "expected", inserted.alias("inserted"),
                        F.when(inserted < F.col("expected"), "lost").when(inserted > F.col("expected"), "doubled").otherwise("ok").alias("status"),
                        F.array_except(names("files"), names("files_now")).alias("missing_files"),
                        F.array_except(names("files_now"), names("files")).alias("unknown_files"))
