"""Observation mapping (path A): raw text rows -> validated, labelled,
UTC-timed observations with deterministic ids, plus a reject frame.

Plan shape: one scan of the fact, broadcast lookups (one stage, no shuffle of
the fact when the catalogue is small), then an optional shuffle only for
de-duplication or per-datastream aggregates. The only Python on the fact path
is the Arrow-batched FNV fold of the observation id (``functions.ids``).

Reject reasons, in the order the reference checks them:

* ``unknown_station``      no station at all (an event without a customer)
* ``unknown_series``       datastream not in the catalogue (J1; silent there)
* ``bad_date_part``        year, month or day not an integer (P7)
* ``bad_hour``             hour text without ``:`` or not numeric (P7)
* ``bad_value``            value not a number after decimal-comma rules (P7, F2, D2)
* ``invalid_datetime``     impossible calendar time, e.g. 30 Feb, 24:00 (P8)
* ``unknown_compartment``  compartment code absent (J3, D3)
* ``unknown_organisation`` editor organisation absent (J4, D3)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import ids
from tidewater.functions.text import citation, decimal_comma_lenient
from tidewater.functions.time import instant_text, local_to_utc, local_wall_time, split_hour
from tidewater.operators.joins import bounded_broadcast
from tidewater.plans.catalog import DS_KEYS, Catalog

REJECT_ORDER = ["unknown_station", "unknown_series", "bad_date_part", "bad_hour", "bad_value", "invalid_datetime",
                "unknown_compartment", "unknown_organisation"]


def typed(raw: DataFrame) -> DataFrame:
    """S6 + P7: typed columns next to the text ones (try_cast, never fail)."""
    h, m = split_hour("ORA")
    return raw.withColumns({
        "year": F.trim("ANNO").try_cast("int"), "month": F.trim("MESE").try_cast("int"),
        "day": F.trim("GIORNO").try_cast("int"), "hour": h, "minute": m,
        "result": decimal_comma_lenient("VALORE")})


def own_reason() -> Column:
    """The reject reason that a typed row gives by its own text, else NULL."""
    return (F.when(F.col("year").isNull() | F.col("month").isNull() | F.col("day").isNull(), "bad_date_part")
            .when(F.col("hour").isNull() | F.col("minute").isNull(), "bad_hour")
            .when(F.col("result").isNull(), "bad_value")
            .when(F.col("_local").isNull(), "invalid_datetime"))


def map_all(cat: Catalog, raw: DataFrame | None = None, once: bool = False) -> DataFrame:
    """Every raw row with its mapping or its ``reject_reason``. ``once``: the
    caller reads the result a single time and the catalogue nowhere else
    (``Catalog.mapped_datastreams``)."""
    raw = cat.source.raw_observations() if raw is None else raw
    meta = cat.meta
    ds = (cat.mapped_datastreams() if once else cat.datastreams()).select(
        *DS_KEYS, "datastream_key", "datastream_id", "obs_hash_state", F.lit(True).alias("_known"))
    comp = cat.compartments().select("COMPARTIMENTO", F.col("NOME_COMPARTIMENTO").alias("district"))
    orgs = cat.organisations().select(
        "SIGLA_ENTE_COMPILATORE", F.col("NOME_ENTE_COMPILATORE").alias("editor_organization"),
        F.col("RUOLO_ENTE_COMPILATORE").alias("editor_role"))
    flags = cat.flag_labels()

    # what a row's own text decides is decided before the lookups, so that one
    # column of it crosses the shuffle to a large catalogue
    t = typed(raw).withColumn("_local", local_wall_time("year", "month", "day", "hour", "minute"))
    t = t.withColumn("_own_reason", own_reason())
    t = (t.join(bounded_broadcast(ds), DS_KEYS, "left")
         .join(bounded_broadcast(flags), "FLAG_VALORE", "left")
         .join(bounded_broadcast(comp), "COMPARTIMENTO", "left")
         .join(bounded_broadcast(orgs), "SIGLA_ENTE_COMPILATORE", "left"))
    reason = (F.when(F.col("ALIAS_STAZIONE").isNull(), "unknown_station")
              .when(F.col("_known").isNull(), "unknown_series")
              .when(F.col("_own_reason").isNotNull(), F.col("_own_reason"))
              .when(F.col("district").isNull(), "unknown_compartment")
              .when(F.col("editor_organization").isNull(), "unknown_organisation"))
    utc = local_to_utc("_local", cat.time_zone)
    return t.withColumns({
        "reject_reason": reason, "phenomenon_ts": utc, "phenomenon_time": instant_text(utc),
        "flag_label": F.coalesce(F.col("flag_label"), F.col("FLAG_VALORE")),
        "citation": citation(F.lit(meta["Reference_Author"]), F.lit(meta["Reference_Title"]), F.col("district"),
                             F.col("year"), F.col("PARTE_ANNALE"), F.col("PAGINA"), F.col("TABELLA_ORDINE"),
                             F.lit(meta["DataSource"]))})


def good(mapped: DataFrame) -> DataFrame:
    """Mapped observations (rows without a reject reason), model columns."""
    g = mapped.filter(F.col("reject_reason").isNull())
    return g.select(
        ids.observation_id("obs_hash_state", "phenomenon_time").alias("obs_id"),
        "datastream_key", "datastream_id", "phenomenon_ts", "phenomenon_time", "result",
        F.col("FLAG_VALORE").alias("flag"), "flag_label", "citation",
        F.col("NOME_COMPILATORE").alias("editor_individual"), "editor_organization", "editor_role",
        F.col("SIGLA_ENTE_COMPILATORE").alias("editor_code"),
        F.col("NOME_STAZIONE_ANNALE").alias("station_name"), F.col("NOME_BACINO_ANNALE").alias("basin_name"),
        F.col("TIPO_STRUMENTO_ANNALE").alias("instrument_type"),
        F.col("QUOTA_STRUMENTO_ANNALE").alias("instrument_quote"),
        *DS_KEYS, "_ord")


def rejects(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("reject_reason").isNotNull())


def map_observations(cat: Catalog, raw: DataFrame | None = None, once: bool = False) -> DataFrame:
    return good(map_all(cat, raw, once))


def reject_counts(cat: Catalog, raw: DataFrame | None = None) -> DataFrame:
    """Rejects per reason (the reference logs them one line per row)."""
    return (rejects(map_all(cat, raw, once=True)).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def observation_model(obs: DataFrame) -> DataFrame:
    """Observation entity with nested quality and parameters (F19), for JSON
    sinks. Scalar queries use ``good`` directly."""
    return obs.select(
        F.col("obs_id").alias("iot_id"), "datastream_key", "datastream_id",
        F.col("phenomenon_time").alias("phenomenonTime"), "result",
        F.struct(F.struct(F.col("flag").alias("code"), F.col("flag_label").alias("label")).alias("DQ_Status"))
        .alias("resultQuality"),
        F.struct(F.col("citation").alias("referenceCitation"),
                 F.col("editor_individual").alias("editorIndividual"),
                 F.col("editor_organization").alias("editorOrganization"),
                 F.col("editor_role").alias("editorRole"),
                 F.col("station_name").alias("annalStationName"),
                 F.col("basin_name").alias("annalBasinName"),
                 F.col("instrument_type").alias("annalInstrumentType"),
                 F.col("instrument_quote").alias("annalInstrumentQuote")).alias("parameters"),
        "_ord")
