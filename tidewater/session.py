"""Spark session defaults for tidewater jobs."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater") -> SparkSession:
    """Session with the settings every job here assumes.

    * session time zone UTC: local wall times are converted explicitly (F6);
    * AQE on, with partition coalescing and skew-join splitting, so the static
      ``spark.sql.shuffle.partitions`` is an upper bound, not a guess;
    * UI off (no server).
    On a cluster pass ``master=None`` and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset on a local master -- tests -- a fresh
    scratch folder is created and registered; a cluster without a shared folder
    is an error, as no executor would see the driver's own folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at run time
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut:
    several uses read it instead of computing it again, and none of it is lost
    with an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of ``schema``, known as such to the optimizer: unlike an empty
    ``createDataFrame`` it starts no tasks and no Python."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def scale_settings(input_bytes: int, executors: int, cores_per_executor: int = 4,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for an input volume (spill-aware).

    * scan splits of ``target_partition_bytes`` (256 MiB): a task's input
      decompresses to well under an executor core's memory share;
    * the static shuffle partition count covers the whole input at that size
      (AQE only coalesces, it never splits a normal shuffle), and is at least
      three waves of the cluster's cores;
    * AQE's advisory size matches, and skew splitting starts at 4x that size,
      so one hot datastream is cut into ~256 MiB pieces in joins.
    For 100 TB on 1,000 executors x 4 cores: 409,600 shuffle partitions.
    """
    cores = executors * cores_per_executor
    shuffle = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)
