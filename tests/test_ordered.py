"""Skew-safe rank / running sum / lag equal plain windows, also when one key
holds most rows and buckets are tiny."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.ordered import lag_within, rank_within, running_sum


def _data(spark):
    # key 'hot' holds 2/3 of the rows
    rows = [("hot" if i % 3 else f"k{i % 5}", i * 37 % 601, i % 4) for i in range(600)]
    return spark.createDataFrame(rows, "key string, ord long, v long")


def test_rank_matches_row_number(spark):
    df = _data(spark)
    got = rank_within(df, ["key"], "ord", "rn", bucket_width=16)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("ord")))
    assert sorted(got.select("key", "ord", "rn").collect()) == sorted(ref.select("key", "ord", "rn").collect())


def test_running_sum_and_lag(spark):
    df = _data(spark)
    got = running_sum(df, ["key"], "ord", F.col("v"), "s", bucket_width=8)
    w = Window.partitionBy("key").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("s", F.sum("v").over(w))
    assert sorted(got.select("key", "ord", "s").collect()) == sorted(ref.select("key", "ord", "s").collect())
    lg = lag_within(df, ["key"], "ord", "v", "p", bucket_width=8)
    ref2 = df.withColumn("p", F.lag("v").over(Window.partitionBy("key").orderBy("ord")))
    assert sorted(lg.select("key", "ord", "p").collect()) == sorted(ref2.select("key", "ord", "p").collect())


def test_scale_settings():
    from tidewater.session import scale_settings

    s = scale_settings(100 * 1024 ** 4, 1000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10 ** 6, 2)["spark.sql.shuffle.partitions"] == "24"
