"""Observation file order (O1, K1) and report orders (O2, O3 live in stats).

O1: by compartment, basin, station, quantity (text), then year, month, day as
integers with blank or bad values last, stable on arrival order. A global
sort is a range-partitioned shuffle (Spark samples the keys, so one hot
series spreads over several partitions) plus a sort within partitions;
nothing is funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import DEFAULT_BUCKET_WIDTH, _bucket, rank_within

TEXT_KEYS = ["COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA"]
INT_MAX = 2147483647


def numeric_sort_key(text: str) -> Column:
    """Integer value of a date part; blank or bad -> after every number."""
    return F.coalesce(F.trim(F.col(text)).try_cast("int"), F.lit(INT_MAX))


def sort_columns(ord_col: str = "_ord") -> list[Column]:
    return ([F.col(k) for k in TEXT_KEYS]
            + [numeric_sort_key(c) for c in ("ANNO", "MESE", "GIORNO")] + [F.col(ord_col)])


def sorted_observations(raw: DataFrame, n_partitions: int | None = None, ord_col: str = "_ord") -> DataFrame:
    """K1 input: rows range-partitioned and sorted in O1 order (write it with
    ``sinks.files.write_sorted``)."""
    keys = sort_columns(ord_col)
    r = raw.repartitionByRange(n_partitions, *keys) if n_partitions else raw.repartitionByRange(*keys)
    return r.sortWithinPartitions(*keys)


def position_in_series(raw: DataFrame, ord_col: str = "_ord") -> DataFrame:
    """O1 checked per series: 1-based position of each row in O1 order
    within its (compartment, basin, station, quantity). Skew-safe rank: a
    bucket is one calendar day (bad parts last) and one stretch of arrival, so
    it is bounded even if one series has all its rows on one day."""
    d = (raw.withColumn("_y", numeric_sort_key("ANNO")).withColumn("_m", numeric_sort_key("MESE"))
         .withColumn("_d", numeric_sort_key("GIORNO")))
    r = rank_within(d, TEXT_KEYS, "_y", "position", tie_cols=["_m", "_d", ord_col],
                    bucket=F.struct("_y", "_m", "_d", _bucket(raw, ord_col, DEFAULT_BUCKET_WIDTH).alias("_o")))
    return r.drop("_y", "_m", "_d")
