"""Path-B load: observation groups by site x quantity, site metadata sets and
tags, layered series defaults, unit check, cleaned and de-duplicated
observations (A5-A7, A10, J11-J14, F4, F5, F10, F24, P9, W1, K7).

Both passes of the reference over the fact (station metadata, then values)
are aggregates over one scan here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import key_text, norm_key_part, optional_text
from tidewater.functions.time import add_iso_period, local_to_utc, local_wall_time
from tidewater.operators import quality
from tidewater.operators.joins import bounded_broadcast
from tidewater.plans.catalog import Catalog
from tidewater.plans.mapping import typed

GROUP_KEYS = ["COMPARTIMENTO", "ALIAS_STAZIONE", "ALIAS_BACINO", "GRANDEZZA"]
SITE_KEYS_B = ["COMPARTIMENTO", "ALIAS_STAZIONE", "ALIAS_BACINO"]
TAG_MAX = 255

# Path-B datastream defaults.
DEFAULT_STATISTIC = "Total"
DEFAULT_UNIT = "days"
DEFAULT_MEDIUM = "Air"


def timed(cat: Catalog, raw: DataFrame | None = None) -> DataFrame:
    """Typed rows with a UTC time; rows whose date or hour does not make a
    time are dropped (the reference coerces and drops them, P8)."""
    raw = cat.source.raw_observations() if raw is None else raw
    t = typed(raw)
    local = local_wall_time("year", "month", "day", "hour", "minute")
    return (t.withColumn("phenomenon_ts", local_to_utc(local, cat.time_zone))
            .filter(F.col("phenomenon_ts").isNotNull()))


# ------------------------------------------------------------ site metadata
def site_sets(raw: DataFrame) -> DataFrame:
    """A5 + A6: per site the sorted distinct table orders, pages, parts and
    instrument types (cut at 255 characters as tags), and the distinct
    (organisation, editor) pairs. Reads every row, valid or not."""
    def tag(c: str):
        return F.substring(F.array_join(F.sort_array(F.collect_set(F.col(c))), ","), 1, TAG_MAX)

    return raw.groupBy(*SITE_KEYS_B).agg(
        tag("TABELLA_ORDINE").alias("annals_table"), tag("PAGINA").alias("annals_page"),
        tag("PARTE_ANNALE").alias("annals_part"),
        F.sort_array(F.collect_set("TIPO_STRUMENTO_ANNALE")).alias("instrument_types"))


def site_sensor_tag(sets: DataFrame, instruments: DataFrame) -> DataFrame:
    """D13 intent: ``sensor_type`` tag = descriptions of the site's instrument
    types (code when no description), sorted, joined by ``,``, cut at 255."""
    ex = sets.select(*SITE_KEYS_B, F.explode("instrument_types").alias("TIPO_STRUMENTO_ANNALE"))
    ins = instruments.select("TIPO_STRUMENTO_ANNALE", "DESCRIZIONE_TIPO_STRUMENTO_ANNALE").dropDuplicates(
        ["TIPO_STRUMENTO_ANNALE"])
    j = ex.join(bounded_broadcast(ins), "TIPO_STRUMENTO_ANNALE", "left")
    d = F.coalesce(F.nullif(F.col("DESCRIZIONE_TIPO_STRUMENTO_ANNALE"), F.lit("")), F.col("TIPO_STRUMENTO_ANNALE"))
    return j.groupBy(*SITE_KEYS_B).agg(
        F.substring(F.array_join(F.sort_array(F.collect_list(d)), ","), 1, TAG_MAX).alias("sensor_type"))


def organisation_tags(raw: DataFrame, orgs: DataFrame) -> DataFrame:
    """A7 (D13): per site one tag per distinct (organisation, editor) pair --
    every organisation also appears once without an editor -- numbered in
    sorted order: ``name: …, email: …, individual: …, role: …`` cut at 255.
    Roles are split on ``,`` without trimming, as written."""
    ed = F.nullif(F.trim(F.col("NOME_COMPILATORE")), F.lit(""))
    org = F.col("SIGLA_ENTE_COMPILATORE")
    with_editor = raw.select(*SITE_KEYS_B, org.alias("org"), ed.alias("editor"))
    pairs = (with_editor.select(*SITE_KEYS_B, "org", F.lit(None).cast("string").alias("editor"))
             .unionByName(with_editor.filter(F.col("editor").isNotNull()))
             .filter(F.col("org").isNotNull()).distinct())
    o = orgs.select(F.col("SIGLA_ENTE_COMPILATORE").alias("org"), F.col("NOME_ENTE_COMPILATORE").alias("_name"),
                    F.col("RUOLO_ENTE_COMPILATORE").alias("_roles"),
                    F.nullif(F.trim("EmailpuntoContatto"), F.lit("")).alias("_email")).dropDuplicates(["org"])
    j = pairs.join(bounded_broadcast(o), "org", "left")
    roles = F.transform(F.split(F.col("_roles"), ","), lambda r: F.concat(F.lit(", role: "), r))
    value = F.concat(
        F.lit("name: "), F.coalesce(F.col("_name"), F.col("org")),
        F.when(F.col("_email").isNotNull(), F.concat(F.lit(", email: "), F.col("_email"))).otherwise(F.lit("")),
        F.when(F.col("editor").isNotNull(), F.concat(F.lit(", individual: "), F.col("editor"))).otherwise(F.lit("")),
        F.coalesce(F.array_join(roles, ""), F.lit("")))
    from pyspark.sql import Window
    w = Window.partitionBy(*SITE_KEYS_B).orderBy("org", F.col("editor").asc_nulls_first())
    return j.select(*SITE_KEYS_B, "org", "editor",
                    F.concat(F.lit("organization_"), F.row_number().over(w).cast("string")).alias("tag"),
                    F.substring(value, 1, TAG_MAX).alias("value"))


def site_coordinates(groups: DataFrame, cat: Catalog) -> DataFrame:
    """Coordinates of each site; absent station -> NULLs."""
    st = cat.stations()
    return groups.join(bounded_broadcast(st), SITE_KEYS_B, "left")


# ---------------------------------------------------------- series defaults
def _series_entries(series: DataFrame, quantities: DataFrame) -> DataFrame:
    """Series-file entries keyed by the normalised 4-part key (F4), with the
    quantity defaults filling what the series row leaves open (J13)."""
    fields = ["INTERPOLATION_TYPE", "AGGREGATION_PERIOD", "INTENDED_TIME_SPACING", "INTENDED_TIME_SPACING_UNIT"]
    s = series.select(norm_key_part("COMPARTIMENTO").alias("k_c"), norm_key_part("ALIAS_STAZIONE").alias("k_s"),
                      norm_key_part("ALIAS_BACINO").alias("k_b"), norm_key_part("GRANDEZZA").alias("k_q"),
                      *fields, "_ord")
    s = s.filter((F.col("k_c") != "") & (F.col("k_s") != "") & (F.col("k_q") != ""))
    # repeated rows of a series are merged field by field: the last row that fills a field gives it
    filled = [F.max_by(optional_text(c), F.when(optional_text(c).isNotNull(), F.col("_ord"))).alias(c) for c in fields]
    s = s.groupBy("k_c", "k_s", "k_b", "k_q").agg(*filled)
    s = add_iso_period(s, "AGGREGATION_PERIOD", "_pv", "_pu")
    pv, pu = F.col("_pv"), F.col("_pu")
    spacing = F.col("INTENDED_TIME_SPACING").try_cast("double").cast("long")
    s = s.select("k_c", "k_s", "k_b", "k_q", optional_text("INTERPOLATION_TYPE").alias("s_stat"),
                 pv.alias("s_interval"), pu.alias("s_unit"),
                 F.coalesce(spacing, pv).alias("s_spacing"),
                 F.coalesce(optional_text("INTENDED_TIME_SPACING_UNIT"), pu).alias("s_spacing_unit"))
    q = _quantity_defaults(quantities)
    e = s.join(bounded_broadcast(q), "k_q", "left")
    return e.select("k_c", "k_s", "k_b", "k_q",
                    F.coalesce("s_stat", "q_stat").alias("e_stat"),
                    F.coalesce("s_interval", "q_interval").alias("e_interval"),
                    F.coalesce("s_unit", "q_unit").alias("e_unit"),
                    F.coalesce("s_spacing", "q_interval").alias("e_spacing"),
                    F.coalesce("s_spacing_unit", "q_unit").alias("e_spacing_unit"),
                    F.col("q_medium").alias("e_medium"))


def _quantity_defaults(quantities: DataFrame) -> DataFrame:
    q = add_iso_period(quantities, "AGGREGATION_PERIOD", "q_interval", "q_unit")
    q = q.select(norm_key_part("GRANDEZZA").alias("k_q"), optional_text("INTERPOLATION_TYPE").alias("q_stat"),
                 "q_interval", "q_unit", optional_text("SAMPLE_MEDIUM").alias("q_medium"))
    return q.filter(F.col("k_q") != "").dropDuplicates(["k_q"])


def series_defaults(groups: DataFrame, series: DataFrame, quantities: DataFrame) -> DataFrame:
    """J12 + J13: per group the series entry for the exact normalised key,
    else for the same key with a blank basin, else none; then the layered
    defaults: entry values (positive numbers only), constants otherwise. With
    no entry at all only the quantity's medium is taken (as written)."""
    e = _series_entries(series, quantities)
    g = groups.select(*GROUP_KEYS, norm_key_part("COMPARTIMENTO").alias("k_c"),
                      norm_key_part("ALIAS_STAZIONE").alias("k_s"), norm_key_part("ALIAS_BACINO").alias("k_b"),
                      norm_key_part("GRANDEZZA").alias("k_q"))
    cols = ["e_stat", "e_interval", "e_unit", "e_spacing", "e_spacing_unit", "e_medium"]
    exact = e.select("k_c", "k_s", "k_b", "k_q", F.lit(True).alias("x_hit"), *[F.col(c).alias("x" + c) for c in cols])
    blank = e.filter(F.col("k_b") == "").select("k_c", "k_s", "k_q", F.lit(True).alias("f_hit"),
                                                 *[F.col(c).alias("f" + c) for c in cols])
    j = (g.join(bounded_broadcast(exact), ["k_c", "k_s", "k_b", "k_q"], "left")
         .join(bounded_broadcast(blank), ["k_c", "k_s", "k_q"], "left"))
    use_x = F.col("x_hit").isNotNull()
    use_f = ~use_x & (F.col("k_b") != "") & F.col("f_hit").isNotNull()
    hit = use_x | use_f

    def pick(c):
        return F.when(use_x, F.col("x" + c)).when(use_f, F.col("f" + c))

    qd = _quantity_defaults(quantities).select("k_q", F.col("q_medium").alias("_qm"))
    j = j.join(bounded_broadcast(qd), "k_q", "left")
    pos = lambda c: F.when(pick(c) > 0, pick(c))
    return j.select(
        *GROUP_KEYS, hit.alias("has_series_entry"),
        F.coalesce(F.when(hit, pick("e_stat")), F.lit(DEFAULT_STATISTIC)).alias("aggregation_statistic"),
        F.coalesce(F.when(hit, pos("e_interval")), F.lit(1)).cast("long").alias("time_aggregation_interval"),
        F.coalesce(F.when(hit, pick("e_unit")), F.lit(DEFAULT_UNIT)).alias("time_aggregation_interval_unit"),
        F.coalesce(F.when(hit, pos("e_spacing")), F.lit(1)).cast("long").alias("intended_time_spacing"),
        F.coalesce(F.when(hit, pick("e_spacing_unit")), F.lit(DEFAULT_UNIT)).alias("intended_time_spacing_unit"),
        F.coalesce(F.when(hit, pick("e_medium")), F.col("_qm"), F.lit(DEFAULT_MEDIUM)).alias("sampled_medium"))


# ---------------------------------------------------------------- units
def group_units(groups: DataFrame, quantities: DataFrame, units: DataFrame) -> DataFrame:
    """Quantity -> instrument class -> unit; ``udm`` NULL when the class
    has no unit (the group is skipped with a warning)."""
    q = quantities.select("GRANDEZZA", "SIGLA_STRUMENTO").dropDuplicates(["GRANDEZZA"])
    u = units.select("SIGLA_STRUMENTO", F.col("UDM").alias("udm")).dropDuplicates(["SIGLA_STRUMENTO"])
    return groups.join(bounded_broadcast(q), "GRANDEZZA", "left").join(bounded_broadcast(u), "SIGLA_STRUMENTO", "left")


# ---------------------------------------------------------- observations
def load_observations(cat: Catalog, raw: DataFrame | None = None) -> DataFrame:
    """K7 input: per group the rows with a numeric result (P9), the flag as a
    qualifier array (F24), duplicates by time removed keeping the first in
    arrival order (W1, global, D5); groups without a unit are left out (J14).
    Keeps ``datastream_key`` for a ``partitionBy`` write."""
    t = timed(cat, raw)
    # J14 depends on the quantity only: a semi join with the (small) table of
    # quantities whose instrument class has a unit, no group-level pass
    q = cat.source.quantities().select("GRANDEZZA", "SIGLA_STRUMENTO").dropDuplicates(["GRANDEZZA"])
    u = cat.source.units().select("SIGLA_STRUMENTO").dropDuplicates()
    with_unit = q.join(u, "SIGLA_STRUMENTO").select("GRANDEZZA")
    t = t.join(bounded_broadcast(with_unit), "GRANDEZZA", "left_semi")
    t = quality.loadable(t)
    t = quality.dedup_first(t.select(*GROUP_KEYS, "phenomenon_ts", "result", "result_qualifier_codes", "_ord"),
                            GROUP_KEYS, "phenomenon_ts", ["_ord"])
    return t.withColumn("datastream_key", key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA"))
