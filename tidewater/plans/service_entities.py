"""Entity records of the service load (path B): sites, sensors, observed
properties, units, processing level, result qualifiers and datastreams, with the
constants and text limits that the service sets.

Every frame has its natural key, so ``operators.entity_store`` can get or create
its rows. Sites and datastreams come from the groups that the fact names; the
fact is read once for both (``loader.GROUP_KEYS``), the rest are lookup tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import key_text, quantity_label
from tidewater.operators.dedup import keep_first
from tidewater.operators.joins import bounded_broadcast
from tidewater.operators.quality import merged_qualifiers
from tidewater.plans import loader
from tidewater.plans.catalog import Catalog

# Constants and text limits of the records.
NAME_MAX, TEXT_MAX = 199, 255
LEVEL_CODE, LEVEL_DEFINITION = "0", "Quality controlled data"
SITE_KIND, SUBJECT, COUNTRY = "Site", "Hydrology", "IT"
DISCLAIMER = "WARNING: These data may be provisional and subject to revision."
NO_DATA = -9999
OBSERVATION_KIND, RESULT_KIND = "Field Observation", "Timeseries"
ENCODING, METHOD, NOT_KNOWN = "application/json", "Sensor", "N/A"


def _cut(c, n: int = TEXT_MAX):
    return F.substring(c, 1, n)


def processing_levels(cat: Catalog) -> DataFrame:
    """One level; its explanation is the metadata's level of data."""
    level = F.lit(cat.meta.get("LevelOfData"))
    return cat.source.spark.range(1).select(F.lit(LEVEL_CODE).alias("level_code"), F.lit(LEVEL_DEFINITION).alias("definition"),
                                            _cut(level).alias("explanation"))


def sites(cat: Catalog, groups: DataFrame) -> DataFrame:
    """A record per site of ``groups``; a site without a station has no place."""
    names = cat.compartments().select("COMPARTIMENTO", F.col("NOME_COMPARTIMENTO").alias("district"))
    keys = groups.select(*loader.SITE_KEYS_B).distinct()
    s = loader.site_coordinates(keys, cat).select(*loader.SITE_KEYS_B, "lon", "lat", "elevation")
    s = s.join(bounded_broadcast(names), "COMPARTIMENTO", "left")
    shown = F.coalesce("district", F.lit("None"))            # as the service writes an absent district
    return s.select(
        key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE").alias("sampling_feature_code"), F.col("ALIAS_STAZIONE").alias("name"),
        F.concat(F.lit("Compartimento: "), shown, F.lit(", bacino: "), "ALIAS_BACINO", F.lit(", stazione: "), "ALIAS_STAZIONE").alias("description"),
        F.lit(SITE_KIND).alias("sampling_feature_type"), F.lit(SUBJECT).alias("site_type"),
        F.col("lat").cast("double").alias("latitude"), F.col("lon").cast("double").alias("longitude"),
        F.col("elevation").cast("double").alias("elevation_m"), F.lit(COUNTRY).alias("country"),
        F.col("district").alias("admin_area_1"), F.col("ALIAS_BACINO").alias("admin_area_2"),
        _cut(F.lit(cat.meta.get("Disclaimer") or DISCLAIMER)).alias("data_disclaimer"))


def sensors(cat: Catalog) -> DataFrame:
    """A record per instrument class of the quantities, named by its category."""
    classes = cat.source.quantities().select("SIGLA_STRUMENTO").distinct()
    labels = keep_first(cat.source.instruments(), ["SIGLA_STRUMENTO"], ["CATEGORIA_STRUMENTO"]).select("SIGLA_STRUMENTO", "CATEGORIA_STRUMENTO")
    named = classes.join(bounded_broadcast(labels), "SIGLA_STRUMENTO", "left")
    name = F.coalesce(F.nullif(F.col("CATEGORIA_STRUMENTO"), F.lit("")), F.col("SIGLA_STRUMENTO"))
    return named.select(F.col("SIGLA_STRUMENTO").alias("method_code"), name.alias("name"), name.alias("description"),
                        F.lit(ENCODING).alias("encoding_type"), F.lit(METHOD).alias("method_type"),
                        F.lit(NOT_KNOWN).alias("manufacturer"), F.lit(NOT_KNOWN).alias("sensor_model"))


def observed_properties(cat: Catalog) -> DataFrame:
    """A record per property URI, named by its label."""
    uri = cat.source.quantities().select(F.col("TIPO_GRANDEZZA").alias("code")).distinct()
    return uri.select("code", quantity_label("code").alias("name"), quantity_label("code").alias("definition"),
                      F.lit(SUBJECT).alias("observed_property_type"))


def units(cat: Catalog) -> DataFrame:
    """A record per unit symbol; the first description names it."""
    u = keep_first(cat.source.units().select("UDM", "DESCRIZIONE_UDM"), ["UDM"], ["DESCRIZIONE_UDM"])
    return u.select(F.col("UDM").alias("symbol"), F.col("DESCRIZIONE_UDM").alias("name"), F.col("DESCRIZIONE_UDM").alias("definition"),
                    F.lit(SUBJECT).alias("unit_type"))


def result_qualifiers(cat: Catalog) -> DataFrame:
    """A record per flag: an existing one is found by the flag alone, so the
    first instrument class in order describes a flag that several have."""
    m = merged_qualifiers(cat.source.flag_quality())
    return keep_first(m, ["FLAG_VALORE"], ["SIGLA_STRUMENTO"]).select(F.col("FLAG_VALORE").alias("code"),
                                                                      F.col("qualifier_description").alias("description"))


def datastreams(cat: Catalog, groups: DataFrame, status: str) -> DataFrame:
    """A record per group whose quantity has a unit, with its layered defaults
    and the keys of the entities it refers to."""
    q = keep_first(cat.source.quantities(), ["GRANDEZZA"], ["DESCRIZIONE_GRANDEZZA"]).select("GRANDEZZA", "DESCRIZIONE_GRANDEZZA", "TIPO_GRANDEZZA")
    g = loader.group_units(groups.select(*loader.GROUP_KEYS), cat.source.quantities(), cat.source.units()).filter(F.col("udm").isNotNull())
    d = loader.series_defaults(groups, cat.source.series_b(), cat.source.quantities())
    j = g.join(bounded_broadcast(q), "GRANDEZZA")
    same = [j[c].eqNullSafe(d[c]) for c in loader.GROUP_KEYS]
    j = j.join(d, same).select(j["*"], *[d[c] for c in d.columns if c not in loader.GROUP_KEYS])
    text = F.col("DESCRIZIONE_GRANDEZZA")
    return j.select(
        key_text("COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE").alias("sampling_feature_code"), F.col("SIGLA_STRUMENTO").alias("method_code"),
        F.col("TIPO_GRANDEZZA").alias("property_code"), F.col("udm").alias("unit_symbol"), F.lit(LEVEL_CODE).alias("level_code"),
        _cut(F.concat("ALIAS_STAZIONE", F.lit(" - "), text), NAME_MAX).alias("name"),
        F.concat(text, F.lit(". Units of measure: "), "udm").alias("description"),
        F.lit(OBSERVATION_KIND).alias("observation_type"), F.lit(RESULT_KIND).alias("result_type"), F.lit(NO_DATA).alias("no_data_value"),
        F.lit(status).alias("status"), "sampled_medium", "aggregation_statistic", "time_aggregation_interval", "time_aggregation_interval_unit",
        "intended_time_spacing", "intended_time_spacing_unit").distinct()
