"""Quality and provenance aggregates.

All are ``groupBy`` aggregates with map-side combine. Collected arrays are
bounded by distinct values (flags per datastream, editors per organisation),
never by rows; the duplicate sample keeps 5 times per series through a
window group limit that runs before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import first_n_per_group, keep_first


def merged_qualifiers(flags: DataFrame) -> DataFrame:
    """A3: per (instrument class, flag) the distinct ``type - text`` parts
    joined by ``; `` in sorted order (D6); a part is just the non-blank one of
    the two when the other is blank; no parts -> ``class flag``. Rows with a
    blank class or flag are skipped."""
    t = flags.select(F.trim("SIGLA_STRUMENTO").alias("cls"), F.trim("FLAG_VALORE").alias("flag"),
                     F.trim("TIPO_VALORE").alias("tv"), F.trim("DESCRIZIONE_FLAG").alias("d"))
    t = t.filter((F.col("cls") != "") & (F.col("flag") != "") & F.col("cls").isNotNull() & F.col("flag").isNotNull())
    tv_ok = F.col("tv").isNotNull() & (F.col("tv") != "")
    d_ok = F.col("d").isNotNull() & (F.col("d") != "")
    part = (F.when(tv_ok & d_ok, F.concat(F.col("tv"), F.lit(" - "), F.col("d")))
            .when(tv_ok, F.col("tv")).when(d_ok, F.col("d")))
    g = t.groupBy("cls", "flag").agg(F.sort_array(F.collect_set(part)).alias("_parts"))
    desc = F.when(F.size("_parts") > 0, F.array_join("_parts", "; ")).otherwise(
        F.concat(F.col("cls"), F.lit(" "), F.col("flag")))
    return g.select(F.col("cls").alias("SIGLA_STRUMENTO"), F.col("flag").alias("FLAG_VALORE"),
                    desc.alias("qualifier_description"))


def datastream_qualifier_map(obs: DataFrame, ds_col: str, flag_col: str, label_col: str) -> DataFrame:
    """Per datastream, map flag -> label of the flags its observations
    carry (distinct pairs first, so the collected array is bounded by the
    number of flags)."""
    pairs = obs.select(ds_col, flag_col, label_col).distinct()
    return pairs.groupBy(ds_col).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(flag_col), F.col(label_col)))))
        .alias("qualifiers"))


def responsible_parties(obs: DataFrame, ds_col: str, org_col: str, editor_col: str,
                        general_parties: Column) -> DataFrame:
    """A9 (D19): per datastream the general organisations plus every
    observing organisation, each with its distinct non-blank editor names.
    General organisations come from a bounded literal array (scalar
    subquery), exploded per datastream -- no cross join."""
    ed = F.nullif(F.trim(F.col(editor_col)), F.lit(""))
    observed = (obs.select(ds_col, F.col(org_col).alias("org_code"), ed.alias("_e"))
                .groupBy(ds_col, "org_code").agg(F.sort_array(F.collect_set("_e")).alias("editors")))
    gen = (obs.select(ds_col).distinct()
           .select(ds_col, F.explode(general_parties).alias("_g"))
           .select(ds_col, F.col("_g.code").alias("org_code"), F.lit(True).alias("is_general")))
    return (observed.join(gen, [ds_col, "org_code"], "full")
            .withColumn("is_general", F.coalesce("is_general", F.lit(False)))
            .withColumn("editors", F.coalesce("editors", F.array().cast("array<string>"))))


def duplicate_report(obs: DataFrame, series: list[str], time_col: str, sample: int = 5) -> DataFrame:
    """Per series the number of duplicate rows by time (all copies but
    the first) and up to ``sample`` duplicated times, smallest first."""
    per_t = obs.groupBy(*series, time_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    counts = per_t.groupBy(*series).agg(F.sum(F.col("_n") - 1).alias("n_duplicates"),
                                        F.count(F.lit(1)).alias("n_duplicate_times"))
    top = first_n_per_group(per_t, series, [time_col], sample)
    samples = top.groupBy(*series).agg(F.sort_array(F.collect_list(time_col)).alias("sample_times"))
    return counts.join(samples, series)


def dedup_first(obs: DataFrame, series: list[str], time_col: str, order: list[str]) -> DataFrame:
    """W1 (D5): keep the first observation per (series, time) in ``order``."""
    return keep_first(obs, series + [time_col], order)


def loadable(obs: DataFrame, result_col: str = "result", flag_col: str = "FLAG_VALORE") -> DataFrame:
    """P9 + F24: rows with a numeric result, flag as a qualifier array."""
    from tidewater.functions.text import qualifier_codes
    return (obs.filter(F.col(result_col).isNotNull())
            .withColumn("result_qualifier_codes", qualifier_codes(flag_col)))


# The missing-value sentinel of the source files.
NO_DATA = -9999.0


def mask_no_data(df: DataFrame, col: str = "result", sentinel: float = NO_DATA) -> DataFrame:
    """The sentinel stays a stored result; this projection turns it into
    NULL so statistics (sums, means, extremes) can leave it out."""
    return df.withColumn(col, F.when(F.col(col) != F.lit(sentinel), F.col(col)))
