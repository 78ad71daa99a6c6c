"""Skew-safe ordered computations over one key: rank, running sum, lag.

A plain ``Window.partitionBy(key).orderBy(ord)`` puts every row of a key into
one task; with one datastream holding a third of all rows that task sorts a
third of the data. Here the ordinal axis is cut into buckets of at most
``bucket_width`` ordinal values:

1. per (key, bucket) partial sums -- a ``groupBy`` with map-side combine;
2. exclusive prefix sums over buckets -- a window over the small count table
   (#buckets rows per key);
3. join the offsets back on (key, bucket) and finish with a window per
   (key, bucket), which is bounded by ``bucket_width`` rows when the ordinal
   is unique within the key.

The join and the final window share the (key, bucket) hash partitioning, so
the fact is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_WIDTH = 1 << 20


def _bucket(df: DataFrame, ord_col: str, width: int) -> Column:
    """Bucket of an ordinal: ``width`` values of a number, or all but the last
    field of a struct (file, split, row): one split of one file."""
    kind = df.schema[ord_col].dataType
    if isinstance(kind, T.StructType):
        return F.struct(*[F.col(ord_col)[f].alias(f) for f in kind.fieldNames()[:-1]])
    return F.floor(F.col(ord_col) / F.lit(width)).cast("long")


def running_sum(df: DataFrame, keys: list[str], ord_col: str, value: Column, out: str,
                tie_cols: list[str] | None = None, bucket_width: int = DEFAULT_BUCKET_WIDTH,
                bucket: Column | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in (``ord_col``,
    ``tie_cols``) order. ``ord_col`` must be a number or an arrival struct
    unless ``bucket`` is given: any column that never decreases along the order (e.g. the year of
    a date-ordered series), bounding the rows per (key, bucket)."""
    tie_cols = tie_cols or []
    b = bucket if bucket is not None else _bucket(df, ord_col, bucket_width)
    d = df.withColumn("_v", value.cast("long")).withColumn("_b", b)
    per_bucket = d.groupBy(*keys, "_b").agg(F.sum("_v").alias("_bsum"))
    w_b = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*keys, "_b", F.coalesce(F.sum("_bsum").over(w_b), F.lit(0)).alias("_off"))
    j = d.join(offsets, keys + ["_b"])
    w = (Window.partitionBy(*keys, "_b").orderBy(ord_col, *tie_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return j.withColumn(out, F.col("_off") + F.sum("_v").over(w)).drop("_v", "_b", "_off")


def rank_within(df: DataFrame, keys: list[str], ord_col: str, out: str = "rn",
                tie_cols: list[str] | None = None, bucket_width: int = DEFAULT_BUCKET_WIDTH,
                bucket: Column | None = None) -> DataFrame:
    """1-based position of each row within its key in ordinal order."""
    return running_sum(df, keys, ord_col, F.lit(1), out, tie_cols, bucket_width, bucket)


def lag_within(df: DataFrame, keys: list[str], ord_col: str, col: str, out: str,
               bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Value of ``col`` on the previous row of the same key (NULL on the
    first). Rows that open a bucket take the last value of the nearest earlier
    non-empty bucket, found on the per-bucket table."""
    d = df.withColumn("_b", _bucket(df, ord_col, bucket_width))
    last_per_bucket = d.groupBy(*keys, "_b").agg(F.max_by(F.col(col), F.col(ord_col)).alias("_blast"))
    w_b = Window.partitionBy(*keys).orderBy("_b")
    prev = last_per_bucket.select(*keys, "_b", F.lag("_blast").over(w_b).alias("_prev_bucket_last"))
    j = d.join(prev, keys + ["_b"])
    w = Window.partitionBy(*keys, "_b").orderBy(ord_col)
    return (j.withColumn(out, F.when(F.row_number().over(w) == 1, F.col("_prev_bucket_last"))
                         .otherwise(F.lag(col).over(w)))
            .drop("_b", "_prev_bucket_last"))
