"""Named queries over the driver tables, one per operator family.

Each function takes (spark, sf_dir) and returns a DataFrame with scalar,
explicitly named columns (the oracle SQL uses the same names).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.joins import bounded_broadcast
from tidewater.plans import mapping
from tidewater.plans.catalog import Catalog
from tidewater.sources.driver import DriverTables

QUERIES: dict = {}


def query(fn):
    """Register a query. Times are rendered as UTC text, so the session time
    zone is pinned to UTC before the plan is built."""
    import functools

    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _utc_text(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """One catalogue per session and data folder, kept on the session object:
    its dimension tables are materialized once and shared by the queries of that
    session, and go with it."""
    held = spark.__dict__.setdefault("_tidewater_catalogs", {})
    key = sf_dir.rstrip("/")
    if key not in held:
        held[key] = Catalog(DriverTables(spark, sf_dir))
    return held[key]


# --------------------------------------------------------------- step 1
@query
def map_observations(spark, sf_dir) -> DataFrame:
    """Mapped observations."""
    g = mapping.map_observations(catalog(spark, sf_dir), once=True)
    return g.select("obs_id", "datastream_key", "phenomenon_time", F.round("result", 2).alias("result"),
                    "flag", "flag_label", "editor_individual", "editor_organization", "editor_role", "citation")


@query
def reject_reasons(spark, sf_dir) -> DataFrame:
    """P7, P8, J1, J3, J4 rejects: rows per reason."""
    return mapping.reject_counts(catalog(spark, sf_dir))


@query
def obs_per_datastream(spark, sf_dir) -> DataFrame:
    """Flagship: mapped observations -> per datastream count, distinct ids
    (D5: same series and time give the same id), first / last time, sum."""
    g = mapping.map_observations(catalog(spark, sf_dir), once=True)
    a = (g.groupBy("datastream_key", "datastream_id")
         .agg(F.count(F.lit(1)).alias("n_obs"),
              F.count_distinct("obs_id").alias("n_ids"),
              F.min("phenomenon_ts").alias("_first"),
              F.max("phenomenon_ts").alias("_last"),
              F.round(F.sum("result"), 2).alias("sum_result")))
    return a.select("datastream_key", "datastream_id", "n_obs", "n_ids", _utc_text("_first").alias("first_time"),
                    _utc_text("_last").alias("last_time"), "sum_result")


# --------------------------------------------------------------- step 2
@query
def thing_table(spark, sf_dir) -> DataFrame:
    """One Thing per station."""
    from tidewater.plans import entities
    t = entities.things(catalog(spark, sf_dir))
    p = F.col("properties")
    return t.select("thing_id", "thing_key", "name", "description",
                    p["district"].alias("district"), p["watershed"].alias("watershed"),
                    p["territoryOfOrigin"].alias("territory"),
                    F.size(p["responsibleParties"]).alias("n_parties"),
                    F.array_join(F.transform(p["responsibleParties"], lambda x: x["code"]), ",").alias("party_codes"))


@query
def location_table(spark, sf_dir) -> DataFrame:
    """station coordinates; elevation optional."""
    from tidewater.plans import entities
    loc = entities.locations(catalog(spark, sf_dir))
    return loc.select("location_id", "thing_id", F.col("lon").cast("double").alias("lon"),
                      F.col("lat").cast("double").alias("lat"),
                      F.col("elevation").cast("double").alias("elevation"),
                      F.size("location.coordinates").alias("n_coords"))


@query
def datastream_table(spark, sf_dir) -> DataFrame:
    """One Datastream per (station, registered quantity)
    whose quantity has a unit."""
    from tidewater.plans import entities
    d = entities.datastreams(catalog(spark, sf_dir))
    p = F.col("properties")
    return d.select("datastream_id", "thing_id", "sensor_id", "observed_property_id", "datastream_key", "name",
                    "description", F.col("unitOfMeasurement.symbol").alias("uom_symbol"),
                    F.col("unitOfMeasurement.name").alias("uom_name"), p["annalVersion"].alias("version"),
                    p["aggregationPeriod"].alias("aggregation_period"),
                    p["aggregationStatistic"].alias("aggregation_statistic"),
                    p["sampledMedium"].alias("sampled_medium"), p["district"].alias("district"))


@query
def sensor_table(spark, sf_dir) -> DataFrame:
    """Sensors keyed by datastream, labelled by class."""
    from tidewater.plans import entities
    s = entities.sensors(catalog(spark, sf_dir))
    return s.select("sensor_id", "datastream_id", "name", F.col("properties.annalsSensorId").alias("sensor_class"))


@query
def observed_property_table(spark, sf_dir) -> DataFrame:
    """One ObservedProperty per quantity URI, with the number of
    its datastreams."""
    from tidewater.operators import navigation as N
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    o = N.child_counts(entities.observed_properties(cat), "definition", cat.datastreams(), "TIPO_GRANDEZZA", "n_datastreams")
    return o.select("observed_property_id", "definition", "name", "description",
                    F.col("properties")["variableCode"].alias("variable_code"), "n_datastreams")


@query
def lookup_last_wins(spark, sf_dir) -> DataFrame:
    """S1 + W5: station registry revisions (one per order of the station's
    customer, in order-key order); a repeated station key keeps its last row."""
    from tidewater.operators import lookups
    from tidewater.plans.catalog import SITE_KEYS
    rev = DriverTables(spark, sf_dir).station_revisions()
    t = lookups.keyed_table(rev, SITE_KEYS)
    return t.select(*SITE_KEYS, F.col("_ord").alias("revision"), F.col("Z_MSLM").alias("elevation_text"))


# --------------------------------------------------------------- step 3
SHOWCASE_BATCH = 5  # observations per batch file in the batch queries


def _mapped(spark, sf_dir, once=False):
    return mapping.map_observations(catalog(spark, sf_dir), once=once)


def _mapped_once(spark, sf_dir, *cols):
    """Mapped observations for plans that use them more than once: scanned,
    parsed and joined one time, the wanted columns kept in shared storage."""
    from tidewater.session import cut
    g = _mapped(spark, sf_dir)
    return cut(g.select(*cols) if cols else g)


def _batched(spark, sf_dir):
    from tidewater.operators import batches
    g = _mapped_once(spark, sf_dir, "obs_id", "datastream_key", "datastream_id", "phenomenon_time", "result", "_ord")
    return batches.number_batches(g, "datastream_key", "_ord", SHOWCASE_BATCH)


@query
def entity_ids(spark, sf_dir) -> DataFrame:
    """Hashes and ids of every datastream's keys."""
    from tidewater.functions import ids
    d = catalog(spark, sf_dir).datastreams()
    return d.select("thing_key", "datastream_key", ids.fnv_hash("datastream_key").alias("key_hash"),
                    "thing_id", ids.entity_id("thing_key", ids.LOCATION_OFFSET).alias("location_id"),
                    "datastream_id", "sensor_id", "observed_property_id")


@query
def observation_ids(spark, sf_dir) -> DataFrame:
    """id from the per-datastream prefix state equals the id from the full
    ``key || NUL || time`` hash."""
    from tidewater.functions import ids
    g = _mapped(spark, sf_dir).select("datastream_key", "phenomenon_time", "obs_id").distinct()
    g = g.withColumn("_full", F.concat("datastream_key", F.expr("chr(0)"), "phenomenon_time"))
    return g.select("datastream_key", "phenomenon_time", "obs_id",
                    ids.observation_id_from_hash(ids.fnv_hash_sql("_full")).alias("obs_id_full"))


@query
def batch_numbers(spark, sf_dir) -> DataFrame:
    """Batch number and position per datastream in arrival order."""
    return _batched(spark, sf_dir).select("obs_id", "datastream_key", "_ord", "batch_no", "batch_pos") \
        .withColumnRenamed("_ord", "arrival")


@query
def batch_extent_first(spark, sf_dir) -> DataFrame:
    """W3 (D7): request index after moving the earliest and latest first."""
    from tidewater.operators import batches
    e = batches.extent_first(_batched(spark, sf_dir), "datastream_key", "phenomenon_time")
    return e.select(F.col("_ord").alias("arrival"), "datastream_key", "batch_no", "request_idx")


@query
def batch_upload_order(spark, sf_dir) -> DataFrame:
    """Upload rank of each batch file: first, last, then the middle."""
    from tidewater.operators import batches
    bt = _batched(spark, sf_dir).groupBy("datastream_key", "batch_no").agg(F.count(F.lit(1)).alias("n_obs"))
    return batches.upload_order(bt, "datastream_key").select("datastream_key", "batch_no", "n_obs", "upload_rank")


@query
def batch_documents(spark, sf_dir) -> DataFrame:
    """Batch documents; request count and the first two request
    times (earliest, latest) per document."""
    from tidewater.operators import batches
    e = batches.extent_first(_batched(spark, sf_dir), "datastream_key", "phenomenon_time")
    e = e.withColumn("iot_id", F.col("obs_id")).withColumn("phenomenonTime", F.col("phenomenon_time"))
    docs = batches.batch_documents(e, "datastream_key", "datastream_id", ["iot_id", "phenomenonTime", "result"])
    r = F.col("doc.requests")
    return docs.select("datastream_key", "batch_no", "file_name", batches.request_count().alias("n_requests"),
                       r[0]["body"]["phenomenonTime"].alias("first_time"),
                       F.when(F.size(r) > 1, r[1]["body"]["phenomenonTime"]).alias("second_time"),
                       r[0]["url"].alias("url"))


RESUME_SPLIT = "2024-01-16T00:00:00Z"


@query
def batch_resume(spark, sf_dir) -> DataFrame:
    """K4: observations before the split are already written in batches; the
    rest is numbered after the highest existing batch of its datastream. Both
    halves are ranked in one pass (the split is part of the rank key) over the
    observations mapped once."""
    from tidewater.operators import batches
    from tidewater.session import cut
    g = _mapped_once(spark, sf_dir, "datastream_key", "phenomenon_time", "_ord").withColumn("_new", F.col("phenomenon_time") >= RESUME_SPLIT)
    g = g.withColumn("_run", F.concat("datastream_key", F.when(F.col("_new"), "|new").otherwise("|old")))
    b = cut(batches.number_batches(g, "_run", "_ord", SHOWCASE_BATCH))
    existing = b.filter(~F.col("_new")).select("datastream_key", "batch_no").distinct()
    res = batches.resume_numbering(b.filter(F.col("_new")), existing, "datastream_key")
    return res.select(F.col("_ord").alias("arrival"), "datastream_key", "batch_no", "batch_pos")


@query
def run_batches(spark, sf_dir) -> DataFrame:
    """Legacy runs -- per district file in arrival order, a new run starts
    when the datastream changes."""
    from tidewater.operators import batches
    g = _mapped_once(spark, sf_dir, "COMPARTIMENTO", "datastream_key", "_ord")
    r = batches.runs(g, "COMPARTIMENTO", "_ord", "datastream_key")
    return r.select(F.col("_ord").alias("arrival"), "COMPARTIMENTO", "datastream_key", "run_no")


# --------------------------------------------------------------- step 4
def _entities(spark, sf_dir):
    from tidewater.plans import report
    return report.build(catalog(spark, sf_dir))


@query
def entity_counts(spark, sf_dir) -> DataFrame:
    """Rows per collection."""
    from tidewater.plans import report
    return report.counts(_entities(spark, sf_dir))


@query
def bbox(spark, sf_dir) -> DataFrame:
    """Bounding box of all location coordinates."""
    from tidewater.plans import report
    return report.bbox(_entities(spark, sf_dir))


@query
def elevation_stats(spark, sf_dir) -> DataFrame:
    """Elevation count, min, max, median, mean; locations without one."""
    from tidewater.plans import report
    e = report.elevation(_entities(spark, sf_dir))
    return e.select("n_elevations", "min_elevation", "max_elevation", F.round("median_elevation", 4).alias("median_elevation"),
                    F.round("mean_elevation", 4).alias("mean_elevation"), "locations_without_elevation")


@query
def period_stats(spark, sf_dir) -> DataFrame:
    """Datastream phenomenonTime coverage."""
    from tidewater.plans import report
    p = report.periods(_entities(spark, sf_dir))
    return p.select("datastreams_scanned", "missing", "unparseable", "zero_length", "sampled",
                    _utc_text("overall_start").alias("overall_start"), _utc_text("overall_end").alias("overall_end"),
                    "span_s", "shortest_id", "shortest_s", "longest_id", "longest_s",
                    F.col("median_s").cast("double").alias("median_s"), "median_text")


@query
def obs_count_stats(spark, sf_dir) -> DataFrame:
    """Observations per datastream (one groupBy, not n+1 counts)."""
    from tidewater.plans import report
    c = report.observation_counts(_entities(spark, sf_dir))
    return c.withColumn("mean_obs", F.round("mean_obs", 4))


@query
def property_tally(spark, sf_dir) -> DataFrame:
    """Tallies of datastream properties and observation type."""
    from tidewater.plans import report
    return report.tallies(_entities(spark, sf_dir)).filter(F.col("property") != "unitOfMeasurement")


@query
def unit_tally(spark, sf_dir) -> DataFrame:
    """Tally of unit texts."""
    from tidewater.plans import report
    return report.tallies(_entities(spark, sf_dir)).filter(F.col("property") == "unitOfMeasurement")


@query
def observed_property_stats(spark, sf_dir) -> DataFrame:
    """Datastreams and observations per ObservedProperty."""
    from tidewater.plans import report
    return report.observed_properties(_entities(spark, sf_dir)).select(
        "observed_property_id", "name", "n_datastreams", "n_observations")


@query
def phenomenon_time(spark, sf_dir) -> DataFrame:
    """Observed interval per datastream."""
    from tidewater.operators import stats
    obs = _mapped(spark, sf_dir, once=True)
    return stats.phenomenon_interval(obs, ["datastream_key", "datastream_id"], "phenomenon_ts").select(
        "datastream_id", "phenomenonTime")


@query
def iso_period(spark, sf_dir) -> DataFrame:
    """Series period (series override, else quantity) -> value, unit."""
    from tidewater.functions.time import add_iso_period
    cat = catalog(spark, sf_dir)
    s = cat.series().select("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA",
                            F.col("AGGREGATION_PERIOD").alias("_sp"))
    q = cat.quantities().select("GRANDEZZA", F.col("AGGREGATION_PERIOD").alias("_qp"))
    j = s.join(bounded_broadcast(q), "GRANDEZZA")
    from tidewater.functions.text import key_text
    j = add_iso_period(j.withColumn("period_text", F.coalesce("_sp", "_qp")), "period_text",
                       "period_value", "period_unit")
    return j.select(key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA").alias("datastream_key"),
                    "period_text", "period_value", "period_unit")


@query
def duration_text(spark, sf_dir) -> DataFrame:
    """Duration of each datastream's observed interval as text."""
    from tidewater.functions.time import duration_text as fmt, parse_interval
    t = phenomenon_time(spark, sf_dir)
    s, e, d = parse_interval("phenomenonTime")
    return t.select("datastream_id", d.alias("duration_s"), fmt(d).alias("duration_text"))


# --------------------------------------------------------------- step 5
def _ds_entities(spark, sf_dir):
    from tidewater.plans import entities
    return entities.datastreams(catalog(spark, sf_dir))


@query
def filter_property_text(spark, sf_dir) -> DataFrame:
    """Datastreams whose aggregationPeriod property equals a text."""
    from tidewater.operators import predicates as P
    d = _ds_entities(spark, sf_dir)
    return d.filter(P.property_equals("aggregationPeriod", "P1D")).select("datastream_id", "datastream_key")


@query
def filter_property_number(spark, sf_dir) -> DataFrame:
    """Numeric comparisons on a text property (version >= 2, != 3)
    combined with a text inequality."""
    from tidewater.operators import predicates as P
    d = _ds_entities(spark, sf_dir)
    cond = P.all_of(P.property_greater_or_equal("annalVersion", 2), P.property_not_equals("annalVersion", 3),
                    P.property_not_equals("aggregationStatistic", "Total"))
    return d.filter(cond).select("datastream_id", "datastream_key")


@query
def filter_property_in(spark, sf_dir) -> DataFrame:
    """P4, P6 or: property in a list, or another property equal."""
    from tidewater.operators import predicates as P
    d = _ds_entities(spark, sf_dir)
    cond = P.any_of(P.property_in("aggregationStatistic", "Maximum", "Minimum"),
                    P.property_equals("annalVersion", 2))
    return d.filter(cond).select("datastream_id", "datastream_key")


@query
def filter_name(spark, sf_dir) -> DataFrame:
    """P5, P6 not: Thing names by prefix / suffix / substring."""
    from tidewater.operators import predicates as P
    from tidewater.plans import entities
    t = entities.things(catalog(spark, sf_dir))
    cond = P.all_of(P.any_of(P.name_starts_with("Customer#00000001"), P.name_ends_with("7")),
                    P.negate(P.name_contains("#00000000")))
    return t.filter(cond).select("thing_id", "name")


@query
def filter_result_time(spark, sf_dir) -> DataFrame:
    """Result bounds and a phenomenonTime window (one bound without a
    zone designator, F7)."""
    from tidewater.operators import predicates as P
    o = _mapped(spark, sf_dir, once=True)
    cond = P.all_of(P.group(P.any_of(P.result_greater_than(400), P.result_less_than(5))),
                    P.time_at_or_after("2024-01-05T00:00:00"), P.time_at_or_before("2024-01-25T12:00:00Z"))
    return o.filter(cond).select("obs_id", "datastream_id", "phenomenon_time", F.round("result", 2).alias("result"))


@query
def find_sensors(spark, sf_dir) -> DataFrame:
    """Sensors by name prefix, observed properties by definition."""
    from tidewater.operators import predicates as P
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    s = entities.sensors(cat).filter(P.name_starts_with("Pluvio")).select(
        F.col("sensor_id").alias("entity_id"), F.lit("Sensor").alias("kind"))
    o = entities.observed_properties(cat).filter(F.col("definition").endswith("/224")).select(
        F.col("observed_property_id").alias("entity_id"), F.lit("ObservedProperty").alias("kind"))
    return s.unionByName(o)


@query
def expand_thing(spark, sf_dir) -> DataFrame:
    """Datastreams with their Thing expanded."""
    from tidewater.operators import navigation as N
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    e = N.expand(entities.datastreams(cat), "thing_key", entities.things(cat), "thing_key", "Thing")
    return e.select("datastream_id", F.col("Thing.thing_id").alias("thing_id"), F.col("Thing.name").alias("thing_name"),
                    F.col("Thing.properties.district").alias("thing_district"))


@query
def navigate_thing(spark, sf_dir) -> DataFrame:
    """Datastreams and locations per Thing (0 when none, D4)."""
    from tidewater.operators import navigation as N
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    t = entities.things(cat).select("thing_key", "thing_id", "name")
    t = N.child_counts(t, "thing_key", entities.datastreams(cat), "thing_key", "n_datastreams")
    t = N.child_counts(t, "thing_key", entities.locations(cat), "thing_key", "n_locations")
    return t.drop("thing_key")


@query
def navigate_property_observations(spark, sf_dir) -> DataFrame:
    """Observations of one ObservedProperty through its datastreams, and
    datastreams found by property name."""
    from tidewater.functions.text import KNOWN_QUANTITY_LABELS
    from tidewater.operators import navigation as N
    from tidewater.plans import entities
    from tidewater.sources.driver import URI_PRECIPITATION
    cat = catalog(spark, sf_dir)
    ds = entities.datastreams(cat)
    o = N.observations_by_property(_mapped(spark, sf_dir), ds, URI_PRECIPITATION)
    by_name = N.datastreams_by_property_name(ds, entities.observed_properties(cat),
                                             KNOWN_QUANTITY_LABELS[URI_PRECIPITATION])
    a = o.groupBy("datastream_key", "datastream_id").agg(F.count(F.lit(1)).alias("n"))
    a = a.select("datastream_id", F.lit("observations").alias("what"), "n")
    b = by_name.select("datastream_id", F.lit("datastream").alias("what"), F.lit(1).cast("long").alias("n"))
    return a.unionByName(b)


# --------------------------------------------------------------- step 6
LINEITEM_SERIES = ["l_suppkey", "l_returnflag"]
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount",
                  "l_tax", "l_linestatus"]


@query
def station_quantity_sets(spark, sf_dir) -> DataFrame:
    """A1: sorted set of quantities per station from the series file."""
    from tidewater.plans.catalog import SITE_KEYS
    s = catalog(spark, sf_dir).series()
    return s.groupBy(*SITE_KEYS).agg(
        F.array_join(F.sort_array(F.collect_set("GRANDEZZA")), ",").alias("quantities"),
        F.count_distinct("GRANDEZZA").alias("n_quantities"))


@query
def flag_descriptions(spark, sf_dir) -> DataFrame:
    """Label of every flag the observations carry (code when absent)."""
    cat = catalog(spark, sf_dir)
    raw = cat.source.raw_observations()
    f = raw.groupBy("FLAG_VALORE").agg(F.count(F.lit(1)).alias("n_obs"))
    return (f.join(bounded_broadcast(cat.flag_labels()), "FLAG_VALORE", "left")
            .select(F.col("FLAG_VALORE").alias("flag"), F.coalesce("flag_label", "FLAG_VALORE").alias("flag_label"),
                    "n_obs"))


@query
def qualifier_merge(spark, sf_dir) -> DataFrame:
    """A3: merged qualifier description per (instrument class, flag) pair the
    path-B observations use; NULL when no qualifier row exists."""
    from tidewater.operators import quality
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    t = loader.timed(cat)
    q = cat.source.quantities().select("GRANDEZZA", "SIGLA_STRUMENTO")
    pairs = (t.join(bounded_broadcast(q), "GRANDEZZA").groupBy("SIGLA_STRUMENTO", "FLAG_VALORE")
             .agg(F.count(F.lit(1)).alias("n_obs")))
    m = quality.merged_qualifiers(cat.source.flag_quality())
    return pairs.join(bounded_broadcast(m), ["SIGLA_STRUMENTO", "FLAG_VALORE"], "left").select(
        F.col("SIGLA_STRUMENTO").alias("instrument_class"), F.col("FLAG_VALORE").alias("flag"),
        "qualifier_description", "n_obs")


@query
def site_sets(spark, sf_dir) -> DataFrame:
    """Per site the tag texts of distinct table orders, pages,
    parts and instrument descriptions."""
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    sets = loader.site_sets(cat.source.raw_observations())
    sensor = loader.site_sensor_tag(sets, cat.source.instruments())
    return sets.join(sensor, loader.SITE_KEYS_B, "left").select(
        *loader.SITE_KEYS_B, "annals_table", "annals_page", "annals_part", "sensor_type")


@query
def organisation_tags(spark, sf_dir) -> DataFrame:
    """Numbered organisation tags per site."""
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    return loader.organisation_tags(cat.source.raw_observations(), cat.source.organisations()).select(
        *loader.SITE_KEYS_B, "tag", "value")


@query
def datastream_qualifiers(spark, sf_dir) -> DataFrame:
    """Flags seen per datastream, as a map flag -> label."""
    from tidewater.operators import quality
    m = quality.datastream_qualifier_map(_mapped(spark, sf_dir, once=True), "datastream_key", "flag", "flag_label")
    return m.select("datastream_key", F.size("qualifiers").alias("n_flags"),
                    F.array_join(F.map_keys("qualifiers"), ",").alias("flags"),
                    F.array_join(F.map_values("qualifiers"), " | ").alias("labels"))


@query
def responsible_parties(spark, sf_dir) -> DataFrame:
    """General organisations plus observing organisations with
    their distinct editors, per datastream."""
    from tidewater.operators import lookups, quality
    cat = catalog(spark, sf_dir)
    parties = lookups.general_parties(cat.source.organisations())
    g = _mapped_once(spark, sf_dir, "datastream_key", "editor_code", "editor_individual")
    r = quality.responsible_parties(g, "datastream_key", "editor_code", "editor_individual",
                                    parties)
    return r.select("datastream_key", "org_code", "is_general", F.size("editors").alias("n_editors"),
                    F.array_join("editors", ",").alias("editors"))


def _groups_b(spark, sf_dir):
    from tidewater.plans import loader
    return loader.timed(catalog(spark, sf_dir)).select(*loader.GROUP_KEYS).distinct()


@query
def series_defaults(spark, sf_dir) -> DataFrame:
    """Resolved datastream attributes per path-B group."""
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    return loader.series_defaults(_groups_b(spark, sf_dir), cat.source.series_b(), cat.source.quantities())


@query
def site_coordinates(spark, sf_dir) -> DataFrame:
    """Coordinates per path-B site; NULL when the station is absent."""
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    sites = _groups_b(spark, sf_dir).select(*loader.SITE_KEYS_B).distinct()
    return loader.site_coordinates(sites, cat).select(
        *loader.SITE_KEYS_B, F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"),
        F.col("elevation").cast("double").alias("elevation"))


@query
def series_without_unit(spark, sf_dir) -> DataFrame:
    """Groups whose quantity's instrument class has no unit (skipped
    with a warning), with their row counts."""
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    t = loader.timed(cat)
    g = t.groupBy(*loader.GROUP_KEYS).agg(F.count(F.lit(1)).alias("n_obs"))
    u = loader.group_units(g, cat.source.quantities(), cat.source.units())
    return u.filter(F.col("udm").isNull()).select(*loader.GROUP_KEYS, "SIGLA_STRUMENTO", "n_obs")


@query
def duplicate_report(spark, sf_dir) -> DataFrame:
    """Duplicates by time per lineitem series and a sample of 5 times."""
    from tidewater.operators import quality
    li = DriverTables(spark, sf_dir).lineitem_observations()
    r = quality.duplicate_report(li, LINEITEM_SERIES, "l_shipdate")
    return r.select(*LINEITEM_SERIES, "n_duplicates", "n_duplicate_times",
                    F.array_join(F.transform("sample_times", lambda t: F.date_format(t, "yyyy-MM-dd")), ",")
                    .alias("sample_times"))


@query
def dedup_first(spark, sf_dir) -> DataFrame:
    """W1 (D5): first lineitem per (series, ship date) in arrival order."""
    from tidewater.operators import quality
    li = DriverTables(spark, sf_dir).lineitem_observations()
    d = quality.dedup_first(li, LINEITEM_SERIES, "l_shipdate", LINEITEM_ORDER)
    return d.select(*LINEITEM_SERIES, F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
                    "l_orderkey", "l_linenumber", "l_extendedprice")


@query
def load_observations(spark, sf_dir) -> DataFrame:
    """Path-B observation load per datastream."""
    from tidewater.plans import loader
    o = loader.load_observations(catalog(spark, sf_dir))
    return o.groupBy("datastream_key").agg(
        F.count(F.lit(1)).alias("n_loaded"),
        F.sum(F.when(F.col("result_qualifier_codes").isNotNull(), 1).otherwise(0)).alias("n_qualified"),
        F.date_format(F.min("phenomenon_ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("first_time"),
        F.date_format(F.max("phenomenon_ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_time"),
        F.round(F.sum("result"), 2).alias("sum_result"))


# --------------------------------------------------------------- step 7
SPLIT_EXISTING = "2024-01-16T00:00:00Z"
OVERLAP_FROM = "2024-01-10T00:00:00Z"
OVERLAP_TO = "2024-01-20T00:00:00Z"


@query
def get_or_create_sites(spark, sf_dir) -> DataFrame:
    """Sites known from the earlier load are reused, new ones created."""
    from tidewater.functions.text import key_text
    from tidewater.operators import upsert
    g = _mapped(spark, sf_dir).withColumn("thing_key", key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE"))
    existing = g.filter(F.col("phenomenon_time") < SPLIT_EXISTING).select("thing_key").distinct()
    new, _ = upsert.get_or_create(g.select("thing_key"), existing, ["thing_key"])
    return (existing.withColumn("origin", F.lit("existing"))
            .unionByName(new.withColumn("origin", F.lit("created"))))


@query
def upsert_datastreams(spark, sf_dir) -> DataFrame:
    """Forced refresh of the path-A datastream attributes from the
    path-B series defaults (a NULL keeps the old value; keys of either side)."""
    from tidewater.functions.text import key_text
    from tidewater.operators import upsert
    from tidewater.plans import loader
    cat = catalog(spark, sf_dir)
    old = cat.datastreams().select("datastream_key", F.col("INTERPOLATION_TYPE").alias("aggregation_statistic"),
                                   F.col("VERSION").alias("version"))
    d = loader.series_defaults(_groups_b(spark, sf_dir), cat.source.series_b(), cat.source.quantities())
    new = d.select(key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA").alias("datastream_key"),
                   F.when(F.col("has_series_entry"), F.col("aggregation_statistic")).alias("aggregation_statistic"))
    r = upsert.refresh(new, old, ["datastream_key"])
    return r.select("datastream_key", "aggregation_statistic", "version", F.col("_origin").alias("origin"))


@query
def write_modes(spark, sf_dir) -> DataFrame:
    """K7, K8, K9: an overlapping batch loaded into a stored table in each write
    mode; rows and distinct ids of the table read back."""
    from functools import reduce

    from tidewater.operators import upsert
    from tidewater.sinks.tables import ObservationTable
    from tidewater.streaming.incremental import scratch
    g = _mapped_once(spark, sf_dir, "obs_id", "datastream_key", "phenomenon_time", "result", "_ord")
    existing = g.filter(F.col("phenomenon_time") < OVERLAP_TO)
    incoming = g.filter(F.col("phenomenon_time") >= OVERLAP_FROM)
    base, schema = scratch(spark, "write-modes"), g.drop("_ord").schema
    parts = []
    for mode in (upsert.NONE, upsert.DELETE_BEFORE_UPLOAD, upsert.DETERMINISTIC_ID):
        table = ObservationTable(spark, f"{base}/{mode}", schema, buckets=8)
        table.load(existing, mode)
        if mode == upsert.NONE:
            table.append(incoming)
        elif mode == upsert.DELETE_BEFORE_UPLOAD:
            table.replace(incoming)
        else:
            table.append_new(incoming, ["datastream_key", "phenomenon_time"], ["_ord"])
        t = table.read()
        parts.append(t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("obs_id").alias("n_ids"))
                     .select(F.lit(mode).alias("mode"), "n_rows", "n_ids"))
    return reduce(DataFrame.unionByName, parts)


@query
def reconcile(spark, sf_dir) -> DataFrame:
    """K9: expected rows per batch against the rows read back from a stored
    table that keeps one row per observation (the first batch's)."""
    from tidewater.operators import upsert
    from tidewater.session import cut
    from tidewater.sinks.tables import ObservationTable
    from tidewater.streaming.incremental import scratch
    b = cut(_batched(spark, sf_dir).select("obs_id", "datastream_key", "phenomenon_time", "batch_no", "_ord"))
    table = ObservationTable(spark, scratch(spark, "reconcile"), b.schema, buckets=8)
    table.append_new(b, ["datastream_key", "phenomenon_time"], ["_ord"])
    r = upsert.reconcile(b, table.read(), ["datastream_key", "batch_no"])
    return r.select("datastream_key", "batch_no", "expected", "visible", "ok")


PROPERTY_TO_DELETE = "Amount of precipitation"


def _cascade(spark, sf_dir):
    from tidewater.operators import cleanup
    from tidewater.plans import entities
    cat = catalog(spark, sf_dir)
    return cleanup.cascade_by_property_name(
        entities.observed_properties(cat), entities.datastreams(cat),
        _mapped(spark, sf_dir).select("obs_id", "datastream_key"),
        entities.things(cat), entities.locations(cat), PROPERTY_TO_DELETE)


@query
def cascade_plan(spark, sf_dir) -> DataFrame:
    """X3 dry run: what a cascade delete by ObservedProperty name removes."""
    from tidewater.operators import cleanup
    return cleanup.plan_counts(_cascade(spark, sf_dir))


@query
def orphan_things(spark, sf_dir) -> DataFrame:
    """Things (and their Locations) left without datastreams by the
    cascade."""
    plan = _cascade(spark, sf_dir).plan
    return plan.filter(F.col("entity").isin("Thing", "Location")).select("entity", "iot_id")


@query
def delete_observations(spark, sf_dir) -> DataFrame:
    """Observations left per datastream after deleting all observations
    of the datastreams aggregated over 3 hours."""
    from tidewater.operators import cleanup
    cat = catalog(spark, sf_dir)
    target = cat.datastreams().filter(F.col("AGGREGATION_PERIOD") == "PT3H").select("datastream_key")
    left = cleanup.delete_observations_of(_mapped(spark, sf_dir), target)
    return (left.groupBy("datastream_key", "datastream_id").agg(F.count(F.lit(1)).alias("n_obs"))
            .select("datastream_id", "n_obs"))


@query
def set_operations(spark, sf_dir) -> DataFrame:
    """U1 union of parts, U2 distinct keys, U3 difference."""
    from tidewater.operators import upsert
    raw = catalog(spark, sf_dir).source.raw_observations()
    # the halves of the table as two frames: U1 adds rows up, whatever the parts are
    rows = raw.select("COMPARTIMENTO", "_ord")
    parts = [rows.filter(F.col("_ord") % 2 == k) for k in (0, 1)]
    u1 = upsert.union_files(parts).agg(F.count(F.lit(1)).alias("n")).select(F.lit("union").alias("op"), "n")
    g = _mapped_once(spark, sf_dir, "obs_id", "datastream_key", "result")
    u2 = g.select("datastream_key").distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit("distinct").alias("op"), "n")
    deleted = g.filter(F.col("result") > 250).select("obs_id", "datastream_key")
    u3 = (upsert.difference(g.select("obs_id", "datastream_key"), deleted).agg(F.count(F.lit(1)).alias("n"))
          .select(F.lit("difference").alias("op"), "n"))
    return u1.unionByName(u2).unionByName(u3)


@query
def patch_entities(spark, sf_dir) -> DataFrame:
    """Delete one Thing by id and rename another by id (ids looked up by
    station name, one row each)."""
    from tidewater.operators import cleanup
    from tidewater.plans import entities
    t = entities.things(catalog(spark, sf_dir)).select("thing_id", "thing_key", "name")
    by_name = lambda n: t.filter(F.col("name") == n).agg(F.min("thing_id")).scalar()
    gone_id, patch_id = by_name("Customer#000000002"), by_name("Customer#000000001")
    out = cleanup.delete_by_id(t, "thing_id", gone_id)
    return cleanup.update_by_id(out, "thing_id", patch_id, {"name": F.lit("Renamed station")})


# --------------------------------------------------------------- step 8
@query
def sorted_observations(spark, sf_dir) -> DataFrame:
    """O1: position of every raw row in file order within its series (text
    keys, then year, month, day as numbers with bad values last, stable)."""
    from tidewater.operators import sorting
    from tidewater.session import cut
    raw = cut(catalog(spark, sf_dir).source.raw_observations().select(*sorting.TEXT_KEYS, "ANNO", "MESE", "GIORNO", "_ord"))
    p = sorting.position_in_series(raw)
    return p.select(*sorting.TEXT_KEYS, "ANNO", "MESE", "GIORNO", F.col("_ord").alias("arrival"), "position")


@query
def sample_per_series(spark, sf_dir) -> DataFrame:
    """W8, P11 (path B): the first 10 loaded observations of each series."""
    from tidewater.operators.dedup import first_n_per_group
    from tidewater.plans import loader
    o = loader.load_observations(catalog(spark, sf_dir))
    s = first_n_per_group(o, ["datastream_key"], ["_ord"], 10)
    return s.groupBy("datastream_key").agg(F.count(F.lit(1)).alias("n"), F.max("_ord").alias("last_arrival"))


@query
def sample_first_mapped(spark, sf_dir) -> DataFrame:
    """P11 (path A): sample mode stops after the 1,001st mapped observation
    in arrival order (a top-k: every task keeps its first 1,001)."""
    g = _mapped(spark, sf_dir, once=True)
    return g.orderBy("_ord").limit(1001).select("obs_id", F.col("_ord").alias("arrival"))


@query
def sample_series(spark, sf_dir) -> DataFrame:
    """P11 (legacy): observations of the first six series to appear."""
    g = _mapped(spark, sf_dir)
    first = g.groupBy("datastream_key").agg(F.min("_ord").alias("_first")).orderBy("_first").limit(6)
    s = g.join(bounded_broadcast(first.select("datastream_key")), "datastream_key", "left_semi")
    return s.groupBy("datastream_key").agg(F.count(F.lit(1)).alias("n_obs"))


@query
def folder_names(spark, sf_dir) -> DataFrame:
    """Folder-safe names of datastream keys and of their first time."""
    from tidewater.functions.text import path_safe
    g = _mapped(spark, sf_dir, once=True).groupBy("datastream_key").agg(F.min("phenomenon_time").alias("t"))
    return g.select("datastream_key", path_safe("datastream_key").alias("folder"), path_safe("t").alias("time_folder"))


@query
def entity_documents(spark, sf_dir) -> DataFrame:
    """K6: deep-insert documents, one per Thing with nested Datastreams."""
    from tidewater.plans import entities
    from tidewater.sinks.files import deep_insert_documents
    cat = catalog(spark, sf_dir)
    d = deep_insert_documents(entities.things(cat), entities.datastreams(cat), entities.sensors(cat),
                              entities.observed_properties(cat))
    return d.select("thing_id", F.size("Datastreams").alias("n_datastreams"),
                    F.col("Datastreams")[0]["name"].alias("first_datastream"),
                    F.col("Datastreams")[0]["Sensor"]["name"].alias("first_sensor"))


# --------------------------------------------------------------- step 9
@query
def incremental_load(spark, sf_dir) -> DataFrame:
    """The events table as a file stream, mapped per
    micro-batch and appended by deterministic id -- run twice with one
    checkpoint (the second run finds no new file) and once more with a fresh
    checkpoint (a full replay that adds no row). Returns the sink's rows per
    datastream."""
    from tidewater.streaming import incremental as inc
    cat = catalog(spark, sf_dir)
    src = cat.source

    def map_batch(events):
        g = mapping.map_observations(cat, src.raw_observations(events))
        return g.select("obs_id", "datastream_key", "phenomenon_time", "result", "flag", "_ord")

    base = inc.scratch(spark, "incremental")
    sink = f"{base}/table"
    for ckpt in ("ckpt-a", "ckpt-a", "ckpt-b"):
        stream = inc.table_stream(spark, sf_dir, "events", src.events_schema())
        inc.run_available_now(spark, stream, map_batch, sink, f"{base}/{ckpt}")
    t = spark.read.parquet(sink)
    return t.groupBy("datastream_key").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("obs_id").alias("n_ids"))


# -------------------------------------------------------------- step 10
def _awkward(raw):
    """Raw rows whose texts need quoting: line breaks, quotes, delimiters."""
    return raw.withColumn("NOME_STAZIONE_ANNALE", F.replace("NOME_STAZIONE_ANNALE", F.lit("#"), F.lit("\n"))) \
        .withColumn("NOME_BACINO_ANNALE", F.concat("NOME_BACINO_ANNALE", F.lit(' "'), "PARTE_ANNALE", F.lit('"; a, b')))


#: Arrival numbers of a district file at most, whatever the table's size.
FILE_WIDTH = 100_000


def _file_width(last: int) -> int:
    """Four stretches of a small table; beyond that the number of files grows, not their size."""
    return min(last // 4 + 1, FILE_WIDTH)


def _files_back(spark, sf_dir, zipped):
    from tidewater.operators.ordered import rank_within
    from tidewater.session import cut
    from tidewater.sinks.districts import write_district_files
    from tidewater.sources.archives import read_zip_csv
    from tidewater.sources.csv_tables import DistrictFolder
    from tidewater.sources.driver import OBSERVATION_COLUMNS
    from tidewater.streaming.incremental import scratch
    root = scratch(spark, "district files")
    src = DriverTables(spark, sf_dir)
    last = src.table("events").agg(F.max("event_id")).first()[0] or 0
    cut(write_district_files(_awkward(src.raw_observations()), root, _file_width(last), OBSERVATION_COLUMNS, zipped))
    back = (read_zip_csv(spark, f"{root}/*/", OBSERVATION_COLUMNS, "osservazioni") if zipped
            else DistrictFolder(spark, root).raw_observations())
    ranked = rank_within(cut(back.select(*OBSERVATION_COLUMNS, "_ord")), ["COMPARTIMENTO"], "_ord", "arrival_rank")
    return ranked.select(*[F.coalesce(c, F.lit("")).alias(c) for c in OBSERVATION_COLUMNS], "arrival_rank")


@query
def csv_round_trip(spark, sf_dir) -> DataFrame:
    """The events as district CSV files in shared storage
    (sub-folders and names with spaces, three delimiters, byte-order marks,
    quoted line breaks), read back in arrival order per district."""
    return _files_back(spark, sf_dir, zipped=False)


@query
def archive_round_trip(spark, sf_dir) -> DataFrame:
    """As ``csv_round_trip`` with every file in a zip archive."""
    return _files_back(spark, sf_dir, zipped=True)


@query
def sorted_files(spark, sf_dir) -> DataFrame:
    """K1, O1: raw rows written as sorted CSV files and read back; the position
    of each row in its series, in file order."""
    from tidewater.operators import sorting
    from tidewater.operators.ordered import rank_within
    from tidewater.session import cut
    from tidewater.sinks.files import write_sorted
    from tidewater.sources.csv_tables import _Fs, read_text_table
    from tidewater.streaming.incremental import scratch
    out = scratch(spark, "sorted")
    write_sorted(sorting.sorted_observations(DriverTables(spark, sf_dir).raw_observations()), out, sep=";")
    files = [f for f in _Fs(spark).list(out) if f.endswith(".csv")]
    cols = [*sorting.TEXT_KEYS, "ANNO", "MESE", "GIORNO", "ORA", "VALORE"]
    back = cut(read_text_table(spark, files, with_order=True).select(*cols, "_ord"))
    return (rank_within(back, sorting.TEXT_KEYS, "_ord", "position")
            .select(*[F.coalesce(c, F.lit("")).alias(c) for c in cols], "position"))


@query
def report_orders(spark, sf_dir) -> DataFrame:
    """O2, O3: the report order of every property tally and of the observed
    properties, as ranks."""
    from pyspark.sql import Window

    from tidewater.operators import stats
    from tidewater.plans import report
    t = _entities(spark, sf_dir)
    tally = report.tallies(t).select("property", "value", "n")
    o2 = Window.partitionBy("property").orderBy(*stats.tally_keys())
    a = tally.select("property", "value", F.row_number().over(o2).alias("rank"))
    o3 = Window.partitionBy("property").orderBy(*stats.property_keys())
    b = report.observed_properties(t).select(F.lit("observedProperty").alias("property"), "name")
    return a.unionByName(b.select("property", F.col("name").alias("value"), F.row_number().over(o3).alias("rank")))


@query
def observation_documents(spark, sf_dir) -> DataFrame:
    """quality and parameters of the nested observation documents."""
    o = mapping.observation_model(_mapped(spark, sf_dir, once=True))
    q, p = F.col("resultQuality.DQ_Status"), F.col("parameters")
    return o.select("iot_id", "datastream_key", "phenomenonTime", q["code"].alias("quality_code"),
                    q["label"].alias("quality_label"), p["referenceCitation"].alias("citation"),
                    p["editorIndividual"].alias("editor"), p["annalStationName"].alias("station_name"),
                    p["annalInstrumentType"].alias("instrument_type"))


@query
def entity_folders(spark, sf_dir) -> DataFrame:
    """Entity documents written to shared storage and read
    back; rows per kind and the Things found by id."""
    from functools import reduce

    from tidewater.plans import entities
    from tidewater.sinks.files import write_entities
    from tidewater.sources.entities import entity_by_id, read_entities
    from tidewater.streaming.incremental import scratch
    cat = catalog(spark, sf_dir)
    out = scratch(spark, "entities")
    write_entities({"Things": entities.things(cat), "Locations": entities.locations(cat),
                    "Datastreams": entities.datastreams(cat), "Sensors": entities.sensors(cat),
                    "ObservedProperties": entities.observed_properties(cat)}, out)
    back = read_entities(spark, out)
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in back.items()]
    smallest = back["Things"].agg(F.min("thing_id")).first()[0]
    one = entity_by_id(back["Things"], "thing_id", smallest)
    parts.append(one.agg(F.count(F.lit(1)).alias("n")).select(F.lit("Thing by id").alias("kind"), "n"))
    return reduce(DataFrame.unionByName, parts)


@query
def published_tree(spark, sf_dir) -> DataFrame:
    """The published folder tree written and read back;
    documents per kind and requests in the batch files."""
    from functools import reduce

    from tidewater.operators import batches
    from tidewater.plans import entities
    from tidewater.session import cut
    from tidewater.sinks.publish import tree_documents, write_tree
    from tidewater.sources.entities import read_tree
    from tidewater.streaming.incremental import scratch
    cat = catalog(spark, sf_dir)
    e = batches.extent_first(_batched(spark, sf_dir), "datastream_key", "phenomenon_time")
    e = e.withColumn("iot_id", F.col("obs_id")).withColumn("phenomenonTime", F.col("phenomenon_time"))
    docs = batches.batch_documents(e, "datastream_key", "datastream_id", ["iot_id", "phenomenonTime", "result"])
    root = scratch(spark, "published")
    cut(write_tree(tree_documents(entities.things(cat), entities.locations(cat), entities.datastreams(cat),
                                  entities.sensors(cat), entities.observed_properties(cat), docs), root))
    back = read_tree(spark, root)
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in back.items()]
    requests = F.size(F.from_json("value", "struct<requests:array<struct<id:string>>>")["requests"])
    parts.append(back["Batches"].agg(F.sum(requests).alias("n")).select(F.lit("Requests").alias("kind"), "n"))
    return reduce(DataFrame.unionByName, parts)


@query
def id_clashes(spark, sf_dir) -> DataFrame:
    """Keys and ids per entity kind. Ids have a limited number of slots;
    joins and deletes use the keys, and this reports where ids clash."""
    from functools import reduce
    cat = catalog(spark, sf_dir)
    frames = [("Thing", cat.datastreams().select(F.col("thing_key").alias("k"), F.col("thing_id").alias("i"))),
              ("Datastream", cat.datastreams().select(F.col("datastream_key").alias("k"), F.col("datastream_id").alias("i"))),
              ("Observation", _mapped(spark, sf_dir).select(F.concat_ws("|", "datastream_key", "phenomenon_time").alias("k"),
                                                            F.col("obs_id").alias("i")))]
    per_id = reduce(DataFrame.unionByName, [df.distinct().groupBy("i").agg(F.count("k").alias("n")).withColumn("entity", F.lit(e))
                                            for e, df in frames])
    return per_id.groupBy("entity").agg(F.sum("n").alias("n_keys"), F.count(F.lit(1)).alias("n_ids"),
                                        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("n_clashing_ids"))


@query
def stored_deletes(spark, sf_dir) -> DataFrame:
    """A stored table after deleting the observations of the datastreams
    aggregated over 3 hours, and after emptying it."""
    from tidewater.operators import cleanup
    from tidewater.sinks.tables import ObservationTable
    from tidewater.streaming.incremental import scratch
    cat = catalog(spark, sf_dir)
    g = _mapped_once(spark, sf_dir, "obs_id", "datastream_key", "phenomenon_time")
    base = scratch(spark, "deletes")
    kept, gone = (ObservationTable(spark, f"{base}/{n}", g.schema, buckets=8) for n in ("kept", "gone"))
    kept.append(g)
    kept.delete(cat.datastreams().filter(F.col("AGGREGATION_PERIOD") == "PT3H"))
    gone.append(g)
    cleanup.empty_collections({"Observations": gone})
    return (kept.read().groupBy("datastream_key").agg(F.count(F.lit(1)).alias("n_obs"))
            .unionByName(gone.read().agg(F.count(F.lit(1)).alias("n_obs")).select(F.lit("(emptied)").alias("datastream_key"), "n_obs")))


@query
def get_or_create_entities(spark, sf_dir) -> DataFrame:
    """J15 for every kind but sites: what the earlier load knows is reused, the
    rest is created. Qualifiers are matched by their flag alone."""
    from functools import reduce

    from tidewater.operators import upsert
    d = catalog(spark, sf_dir).datastreams().select("datastream_key", "SIGLA_STRUMENTO", "TIPO_GRANDEZZA", "uom_symbol")
    g = _mapped(spark, sf_dir).select("datastream_key", "flag", (F.col("phenomenon_time") < SPLIT_EXISTING).alias("old"))
    from tidewater.session import cut
    seen = cut(g.groupBy("datastream_key", "flag").agg(F.max("old").alias("old")).join(d, "datastream_key"))
    parts = []
    for kind, key in (("Sensor", "SIGLA_STRUMENTO"), ("ObservedProperty", "TIPO_GRANDEZZA"), ("Unit", "uom_symbol"),
                      ("ResultQualifier", "flag"), ("Datastream", "datastream_key")):
        rows = seen.select(F.col(key).alias("entity_key"), "old")
        existing = rows.filter("old").select("entity_key").distinct()
        new, _ = upsert.get_or_create(rows.select("entity_key"), existing, ["entity_key"])
        parts += [existing.select(F.lit(kind).alias("kind"), "entity_key", F.lit("existing").alias("origin")),
                  new.select(F.lit(kind).alias("kind"), "entity_key", F.lit("created").alias("origin"))]
    return reduce(DataFrame.unionByName, parts)


@query
def find_datastreams(spark, sf_dir) -> DataFrame:
    """Datastreams by the exact definition of their property, and by a
    property list."""
    from tidewater.operators import predicates as P
    from tidewater.sources.driver import URI_AIR_TEMPERATURE
    d = _ds_entities(spark, sf_dir)
    a = d.filter(F.col("definition") == URI_AIR_TEMPERATURE).select("datastream_key", F.lit("definition").alias("found_by"))
    b = d.filter(P.property_in("aggregationPeriod", "PT3H", "P1M")).select("datastream_key", F.lit("property list").alias("found_by"))
    return a.unionByName(b)


@query
def no_data_statistics(spark, sf_dir) -> DataFrame:
    """The sentinel is stored as a result; statistics leave it out through the
    mask. The highest values stand for the gaps of a yearbook."""
    from tidewater.operators.quality import NO_DATA, mask_no_data
    g = _mapped(spark, sf_dir, once=True).select("datastream_key", F.when(F.col("result") > 90, F.lit(float(NO_DATA))).otherwise(F.col("result")).alias("result"))
    shown = mask_no_data(g.withColumn("stored", F.col("result")))
    return shown.groupBy("datastream_key").agg(
        F.count("stored").alias("n_stored"), F.count("result").alias("n_measured"), F.min("stored").alias("lowest_stored"),
        F.min("result").alias("lowest"), F.round(F.sum("result"), 2).alias("sum_result"))


@query
def property_codes(spark, sf_dir) -> DataFrame:
    """the code of every observed property: ``variableCode``, else ``code``."""
    from tidewater.functions.text import property_code
    from tidewater.plans import entities
    p = entities.observed_properties(catalog(spark, sf_dir)).select("definition", "name", "properties")
    other = p.select("definition", "name", F.create_map(F.lit("code"), F.col("name")).alias("properties"))
    none = p.select("definition", "name", F.create_map(F.lit("unit"), F.col("name")).alias("properties"))
    rows = [f.withColumn("form", F.lit(k)) for k, f in (("variableCode", p), ("code", other), ("neither", none))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).select("definition", "form", property_code("properties").alias("code"))


@query
def run_totals(spark, sf_dir) -> DataFrame:
    """Totals of one mapping run -- things, datastreams, observations
    mapped and rejected."""
    from functools import reduce
    cat = catalog(spark, sf_dir)
    counts = mapping.map_all(cat).agg(F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("observations_mapped"),
                                      F.count(F.when(F.col("reject_reason").isNotNull(), 1)).alias("observations_rejected"))
    parts = [
        cat.stations().agg(F.count(F.lit(1)).alias("n")).select(F.lit("things").alias("metric"), "n"),
        cat.datastreams().agg(F.count(F.lit(1)).alias("n")).select(F.lit("datastreams").alias("metric"), "n"),
        counts.unpivot([], ["observations_mapped", "observations_rejected"], "metric", "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


from tidewater.plans import stored  # noqa: E402,F401  (registers its queries)
