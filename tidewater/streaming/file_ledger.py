"""Re-runs over a folder whose files come, change and go.

``FolderLoad`` keeps a ledger beside its rows: path, length, modification time
and load of every file that the table holds. A run joins the folder's listing
with the ledger, reads only files that are new or differ in length or time, and
appends their rows as one load, each row with the file it came from. The new
ledger is published in one step (``sinks.generations``), so a run that dies adds
nothing, and the next one reads the same files again.

A row counts if the ledger names its file with its load. So the rows of a changed
or vanished file go without anything being rewritten; ``compact`` drops them from
storage. Rows of several files with one identity stay stored, and ``read`` gives
the first in file order: when its file vanishes, the next one stands in. The table
therefore always equals a full load of the folder as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedup import keep_first
from tidewater.operators.joins import bounded_broadcast
from tidewater.session import cut, empty
from tidewater.sinks.generations import GenerationStore
from tidewater.sources.hadoop import Folders, list_files

LEDGER = T.StructType([T.StructField("name", T.StringType()), T.StructField("length", T.LongType()),
                       T.StructField("modified", T.TimestampType()), T.StructField("load", T.StringType())])
FILE, LOAD = "source_file", "load"


def stale_sources(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Of two listings (``hadoop.list_files``) the sources without a target
    of the same name, and those newer than their own target, with ``reason``."""
    t = targets.select("name", F.col("modified").alias("_target"))
    reason = F.when(F.col("_target").isNull(), "no target").when(F.col("modified") > F.col("_target"), "newer than target")
    return sources.join(t, "name", "left").withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_target")


class FolderLoad:
    """``load_files(paths)`` reads files into rows with their path in
    ``source_file`` and ends with the columns ``schema``; ``identity`` and
    ``order`` (within a file) say which of equal rows is the first."""

    def __init__(self, spark: SparkSession, root: str, folder: str, schema: T.StructType,
                 load_files: Callable[[list[str]], DataFrame], identity: list[str], order: list[str], glob: str | None = None):
        self.spark, self.root, self.folder, self.glob = spark, root.rstrip("/"), folder, glob
        self.schema, self.load_files, self.identity, self.order = schema, load_files, identity, order
        self.store = GenerationStore(spark, f"{self.root}/ledger")

    def ledger(self) -> DataFrame:
        at = self.store.snapshot()
        return self.store.read("files", at) if at.tables else empty(self.spark, LEDGER)

    def changes(self) -> DataFrame:
        """(name, path, length, modified, load, state) of every file listed now or
        held: ``new``, ``changed``, ``unchanged`` or ``vanished``."""
        now = list_files(self.spark, self.folder, self.glob)
        held = self.ledger().select("name", F.col("length").alias("_length"), F.col("modified").alias("_modified"), "load")
        j = now.join(held, "name", "full")
        state = (F.when(F.col("load").isNull(), "new").when(F.col("path").isNull(), "vanished")
                 .when((F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified")), "changed")
                 .otherwise("unchanged"))
        return j.select("name", "path", F.coalesce("length", "_length").alias("length"),
                        F.coalesce("modified", "_modified").alias("modified"), "load", state.alias("state"))

    def run(self, files_a_read: int = 10_000) -> DataFrame:
        """Bring the table up to date; returns (state, n) of the files."""
        found = cut(self.changes())
        fresh = found.filter(F.col("state").isin("new", "changed"))
        load = uuid.uuid4().hex
        paths = [r[0] for r in fresh.select("path").orderBy("name").toLocalIterator()]
        for lo in range(0, len(paths), files_a_read):
            rows = self.load_files(paths[lo:lo + files_a_read])
            (rows.select(*self.schema.fieldNames(), FILE).withColumn(LOAD, F.lit(load))
             .write.mode("append").partitionBy(LOAD).parquet(f"{self.root}/rows"))
        kept = found.filter(F.col("state") == "unchanged").select(*LEDGER.fieldNames())
        new = fresh.select("name", "length", "modified", F.lit(load).alias("load"))
        if not found.filter(F.col("state") != "unchanged").isEmpty():
            self.store.commit({"files": kept.unionByName(new)})
        return found.groupBy("state").agg(F.count(F.lit(1)).alias("n"))

    def _stored(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(FILE, T.StringType()), T.StructField(LOAD, T.StringType())])
        if not Folders(self.spark).exists(f"{self.root}/rows"):
            return empty(self.spark, full)
        return self.spark.read.schema(full).parquet(f"{self.root}/rows")

    def live(self) -> DataFrame:
        """Stored rows whose file and load the ledger names; loads that it names
        nowhere are not opened."""
        files = self.ledger().select(F.col("name").alias(FILE), LOAD)
        loads = [r[0] for r in files.select(LOAD).distinct().collect()]      # one per run since the last compaction
        rows = self._stored().filter(F.col(LOAD).isin(loads) if loads else F.lit(False))
        return rows.join(bounded_broadcast(files), [FILE, LOAD], "left_semi")

    def read(self) -> DataFrame:
        """The table: of rows with one identity the first in file order."""
        return keep_first(self.live(), self.identity, [FILE, *self.order]).select(*self.schema.fieldNames())

    def compact(self) -> None:
        """Store the live rows as one load and remove the others."""
        load, old = uuid.uuid4().hex, [r[0] for r in self._stored().select(LOAD).distinct().collect()]
        (self.live().drop(LOAD).withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(LOAD).parquet(f"{self.root}/rows"))
        self.store.commit({"files": cut(self.ledger()).withColumn("load", F.lit(load))})
        for name in old:
            Folders(self.spark).delete(f"{self.root}/rows/{LOAD}={name}")
