"""Endpoint statistics.

The reference pages through every collection and issues one count request
per datastream; here each statistic is one aggregate over an entity table.
Observation counts are a ``groupBy`` with map-side partial aggregation, so
the fact is reduced to one row per datastream before anything else happens.
Exact medians are found by range partitions and counts, never in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import blank_to_missing, missing_or_empty, unit_text
from tidewater.functions.time import duration_text, parse_interval
from tidewater.session import cut



def tally_keys() -> list[Column]:
    return [F.col("n").desc(), F.lower("value")]


def property_keys() -> list[Column]:
    return [F.lower(F.coalesce(F.col("name"), F.lit("")))]


def collection_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per collection; a ``None`` table (skipped count) gives NULL."""
    parts = []
    for name, df in tables.items():
        if df is None:
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), "n"))
    return reduce(DataFrame.unionByName, parts)


def geojson_points(df: DataFrame, id_col: str, geojson_col: str) -> DataFrame:
    """every coordinate tuple of a GeoJSON geometry (point, line,
    polygon, multi-polygon) as (id, lon, lat, elevation). The nesting depth is
    read from the text, so the geometry type does not matter; tuples with
    fewer than two numbers are skipped; elevation only when a third number is
    present and not null."""
    coords = F.get_json_object(F.col(geojson_col), "$.coordinates")
    depth = F.length(F.regexp_extract(F.trim(coords), r"^\[+", 0))
    d1 = F.from_json(coords, "array<double>")
    d2 = F.from_json(coords, "array<array<double>>")
    d3 = F.flatten(F.from_json(coords, "array<array<array<double>>>"))
    d4 = F.flatten(F.flatten(F.from_json(coords, "array<array<array<array<double>>>>")))
    pts = (F.when(depth == 1, F.array(d1)).when(depth == 2, d2).when(depth == 3, d3).when(depth == 4, d4))
    e = df.select(id_col, F.explode_outer(pts).alias("_p"))
    return e.select(id_col,
                    F.when(F.size("_p") >= 2, F.col("_p")[0]).alias("lon"),
                    F.when(F.size("_p") >= 2, F.col("_p")[1]).alias("lat"),
                    F.when(F.size("_p") >= 3, F.col("_p")[2]).alias("elevation"))


def bbox(points: DataFrame) -> DataFrame:
    """Number of points and the bounding box N, W, S, E."""
    p = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return p.agg(F.count(F.lit(1)).alias("n_points"), F.max("lat").alias("north"), F.min("lon").alias("west"),
                 F.min("lat").alias("south"), F.max("lon").alias("east"))


def exact_median(df: DataFrame, col: str) -> Column:
    """The exact median of a column as a literal (double; NULL without values).

    Counts per value are range-partitioned and counted per partition; only the
    partitions that hold the middle ranks are summed up value by value, so no
    task sees all values. Partition counts are all that reaches the driver."""
    counts = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange("v").withColumn("p", F.spark_partition_id()))
    counts = cut(counts)
    parts = sorted(counts.groupBy("p").agg(F.sum("n").alias("n")).collect())
    total = sum(r["n"] for r in parts)
    if not total:
        return F.lit(None).cast("double")
    ranks, before, hits = sorted({(total - 1) // 2, total // 2}), 0, {}
    for r in parts:
        for k in ranks:
            if before <= k < before + r["n"]:
                hits[k] = (r["p"], k - before)
        before += r["n"]
    up_to = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    some = counts.filter(F.col("p").isin([p for p, _ in hits.values()])).withColumn("s", F.sum("n").over(up_to))
    middle = []
    for p, k in hits.values():
        own = some.filter((F.col("p") == p) & (F.col("s") > k)).agg(F.min("v").cast("double")).first()[0]
        middle.append(own)
    return F.lit(sum(middle) / len(middle))


def elevation_stats(points: DataFrame, id_col: str) -> DataFrame:
    """Elevation count, min, max, median, mean over all points; and the
    number of locations without any elevation."""
    per_loc = points.groupBy(id_col).agg(F.count("elevation").alias("_ne"))
    no_elev = per_loc.agg(F.sum(F.when(F.col("_ne") == 0, 1).otherwise(0)).alias("locations_without_elevation"))
    e = points.filter(F.col("elevation").isNotNull()).agg(
        F.count(F.lit(1)).alias("n_elevations"), F.min("elevation").alias("min_elevation"),
        F.max("elevation").alias("max_elevation"), exact_median(points, "elevation").alias("median_elevation"),
        F.avg("elevation").alias("mean_elevation"))
    return _side_by_side(e, no_elev)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row (a scalar subquery, not a join)."""
    cols = [F.col(c) for c in a.columns]
    subs = [b.select(c).scalar().alias(c) for c in b.columns]
    return a.select(*cols, *subs)


def period_stats(ds: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """A14 + W7 + D17: phenomenonTime coverage of datastreams.

    Counts of missing, unparseable, zero-length and sampled periods; overall
    earliest start / latest end and span; shortest and longest datastream
    (first -- smallest id -- wins ties); median duration (exact, seconds)."""
    start, end, dur = parse_interval(time_col)
    t = F.col(time_col)
    missing = t.isNull() | (F.trim(t) == "")
    d = cut(ds.select(id_col, missing.alias("_missing"), start.alias("_s"), end.alias("_e"), dur.alias("_d")))
    ok = F.col("_d").isNotNull()
    return d.agg(
        F.count(F.lit(1)).alias("datastreams_scanned"),
        F.sum(F.when(F.col("_missing"), 1).otherwise(0)).alias("missing"),
        F.sum(F.when(~F.col("_missing") & ~ok, 1).otherwise(0)).alias("unparseable"),
        F.sum(F.when(ok & (F.col("_d") == 0), 1).otherwise(0)).alias("zero_length"),
        F.sum(F.when(ok, 1).otherwise(0)).alias("sampled"),
        F.min("_s").alias("overall_start"), F.max("_e").alias("overall_end"),
        F.min_by(F.when(ok, F.col(id_col)), F.when(ok, F.struct(F.col("_d"), F.col(id_col)))).alias("shortest_id"),
        F.min("_d").alias("shortest_s"),
        F.min_by(F.when(ok, F.col(id_col)), F.when(ok, F.struct(-F.col("_d"), F.col(id_col)))).alias("longest_id"),
        F.max("_d").alias("longest_s"),
    ).withColumn("median_s", exact_median(d, "_d")).withColumn("span_s", F.unix_timestamp("overall_end") - F.unix_timestamp("overall_start")) \
     .withColumn("median_text", duration_text(F.floor("median_s").cast("long")))


def counts_per_datastream(ds: DataFrame, obs: DataFrame, key: str, obs_key: str) -> DataFrame:
    """A15 input: every datastream with its observation count (0 when none);
    the fact is reduced by a partial aggregate before the join."""
    c = obs.groupBy(F.col(obs_key).alias(key)).agg(F.count(F.lit(1)).alias("n_obs"))
    return ds.join(c, key, "left").withColumn("n_obs", F.coalesce("n_obs", F.lit(0)))


def count_stats(per_ds: DataFrame, id_col: str) -> DataFrame:
    """Min and max observation count with their datastream (first id
    wins), integer median (floor, D17), mean, empty count, sample size."""
    per_ds = cut(per_ds.select(id_col, "n_obs"))         # one row per datastream; the fact is counted once
    return per_ds.agg(
        F.min("n_obs").alias("min_obs"),
        F.min_by(F.col(id_col), F.struct("n_obs", id_col)).alias("min_obs_datastream"),
        F.max("n_obs").alias("max_obs"),
        F.min_by(F.col(id_col), F.struct(-F.col("n_obs"), F.col(id_col))).alias("max_obs_datastream"),
        F.floor(exact_median(per_ds, "n_obs")).cast("long").alias("median_obs"),
        F.avg("n_obs").alias("mean_obs"),
        F.sum(F.when(F.col("n_obs") == 0, 1).otherwise(0)).alias("empty_datastreams"),
        F.count(F.lit(1)).alias("sample_size"))


def tally(df: DataFrame, value: Column, label: str) -> DataFrame:
    """Value counts with their share in percent; O2 gives the report
    order (count descending, then value case-blind)."""
    v = df.select(value.alias("value"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return (v.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(label).alias("property"), "value", "n",
                    F.round(F.col("n") * 100.0 / total, 2).alias("pct")))


def tally_order(t: DataFrame) -> DataFrame:
    """O2: count descending, then value case-blind."""
    return t.orderBy(*tally_keys())


def datastream_tallies(ds: DataFrame, props_col: str = "properties") -> DataFrame:
    """A16 for aggregationPeriod, aggregationStatistic, referenceTimeOfDay
    (``(missing)`` / ``(empty)`` rules, F23), observationType and unit (F22)."""
    p = F.col(props_col)
    names = set(ds.schema[props_col].dataType.fieldNames()) if hasattr(ds.schema[props_col].dataType, "fieldNames") else set()

    def prop(k: str) -> Column:
        if names and k not in names:
            return F.lit(None).cast("string")
        return p[k].cast("string")

    parts = [tally(ds, missing_or_empty(prop(k)), k)
             for k in ("aggregationPeriod", "aggregationStatistic", "referenceTimeOfDay")]
    parts.append(tally(ds, blank_to_missing(F.col("observationType")), "observationType"))
    parts.append(tally(ds, unit_text(F.col("unitOfMeasurement.symbol"), F.col("unitOfMeasurement.name")),
                       "unitOfMeasurement"))
    return reduce(DataFrame.unionByName, parts)


def observed_property_stats(props: DataFrame, ds: DataFrame, per_ds: DataFrame) -> DataFrame:
    """A17 + O3: per ObservedProperty its datastream and observation counts
    (two-hop: observation -> datastream -> property, J18)."""
    dsc = ds.groupBy("observed_property_id").agg(F.count(F.lit(1)).alias("n_datastreams"))
    obc = per_ds.groupBy("observed_property_id").agg(F.sum("n_obs").alias("n_observations"))
    out = (props.join(dsc, "observed_property_id", "left").join(obc, "observed_property_id", "left")
           .withColumn("n_datastreams", F.coalesce("n_datastreams", F.lit(0)))
           .withColumn("n_observations", F.coalesce("n_observations", F.lit(0))))
    return out


def observed_property_order(df: DataFrame) -> DataFrame:
    """O3: by name, case-blind, NULL as blank."""
    return df.orderBy(*property_keys())


def phenomenon_interval(obs: DataFrame, ds_cols: list[str], ts_col: str) -> DataFrame:
    """Per datastream the observed interval ``start/end`` (UTC text)."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return (obs.groupBy(*ds_cols).agg(F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))
            .withColumn("phenomenonTime", F.concat(F.date_format("first_ts", fmt), F.lit("/"),
                                                   F.date_format("last_ts", fmt))))
