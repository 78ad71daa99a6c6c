"""Order-dependent de-duplication.

"First wins" and "last wins" are ``row_number() = 1`` per key, which Spark plans
with a window group limit on both sides of the shuffle: every map task sends at
most one row of a key, so a key holding a third of all rows costs one row per
task, and the fact is not sorted twice as a struct-valued aggregate would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ord_struct(order: list[str | Column]) -> Column:
    return F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])


def keep_extreme(df: DataFrame, keys: list[str], order: list[str | Column], first: bool) -> DataFrame:
    """One row per key: the row with the smallest (``first``) or largest order
    tuple. The order tuple must be total (unique per key) for a defined result."""
    by = _ord_struct(order)
    w = Window.partitionBy(*keys).orderBy(by.asc() if first else by.desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in ``order``."""
    return keep_extreme(df, keys, order, first=True)


def last_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Repeated lookup key, the last row (largest ordinal) wins."""
    return keep_extreme(df, keys, order, first=False)


def first_n_per_group(df: DataFrame, keys: list[str], order: list[str | Column], n: int) -> DataFrame:
    """First ``n`` rows per group (sample mode). A bounded top-n per
    group; Spark plans it as a window group limit, which drops rows beyond
    ``n`` before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
