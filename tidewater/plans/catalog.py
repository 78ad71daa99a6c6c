"""Dimension side of the pipeline: stations, series and the datastream
catalogue (J5-J8, J11-J14, F12, F15, F16, F20, D4, D8).

Dimension tables grow with the station catalogue, not with the observations;
they are joined to the fact with ``bounded_broadcast``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import ids
from tidewater.functions.text import decimal_comma_strict, key_text, quantity_label
from tidewater.operators import lookups
from tidewater.operators.joins import bounded_broadcast, bounded_hash, input_bytes, materialized

SITE_KEYS = ["COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE"]
DS_KEYS = SITE_KEYS + ["GRANDEZZA"]

# Station input up to this size gives a catalogue small enough to broadcast; a
# larger one meets the observations by shuffle anyway.
KEPT_BYTES = 4 * 1024 * 1024
# Bytes that the datastreams' keys take in memory per byte of station input: a
# station has several, and its file is compressed.
KEY_BYTES = 64


@dataclass
class Catalog:
    """Lookup and dimension inputs of one run. ``source`` is any object with
    the table methods of ``sources.driver.DriverTables`` or
    ``sources.csv_tables.DistrictFolder``."""

    source: object
    zone: str | None = None
    _meta: dict | None = field(default=None, repr=False)
    _cache: dict = field(default_factory=dict, repr=False)
    _checked: bool = field(default=False, repr=False)

    def _once(self, name: str, build) -> DataFrame:
        """Dimension tables are built and materialized once per catalogue (and
        again if their cache was dropped, e.g. by ``clearCache``)."""
        df = self._cache.get(name)
        if df is None or not df.storageLevel.useMemory and not df.storageLevel.useDisk:
            self._cache[name] = materialized(build())
        return self._cache[name]

    def release(self) -> None:
        for df in self._cache.values():
            df.unpersist()
        self._cache.clear()

    @property
    def meta(self) -> dict:
        if self._meta is None:
            self._meta = lookups.general_metadata(self.source.general_metadata())
        return self._meta

    @property
    def time_zone(self) -> str:
        """Zone parameter, default from the metadata row."""
        return self.zone or self.meta["TimeZone"]

    # ------------------------------------------------------------ sites
    def stations(self) -> DataFrame:
        """S1 + W5 + F1: one row per station key, coordinates as decimals."""
        return self._once("stations", self._stations)

    def _station_rows(self) -> DataFrame:
        return self.source.stations().withColumnRenamed("Compartimento", "COMPARTIMENTO")

    def _stations(self) -> DataFrame:
        s = lookups.keyed_table(self._station_rows(), SITE_KEYS)
        s = s.select(*SITE_KEYS,
                     decimal_comma_strict("X_LONG").alias("lon"),
                     decimal_comma_strict("Y_LAT").alias("lat"),
                     decimal_comma_strict("Z_MSLM").alias("elevation"),
                     key_text(*SITE_KEYS).alias("thing_key"))
        # the thing key is hashed once here; Thing and Location ids derive from it
        return s.withColumn("thing_hash", ids.fnv_hash("thing_key"))

    def series(self) -> DataFrame:
        """Series rows unique on the 4-part key (last wins); rows with a blank
        key part (path-B fallback rows) cannot name a datastream here."""
        s = self.source.series()
        return lookups.keyed_table(s, DS_KEYS, strict=False)

    def quantities(self) -> DataFrame:
        return lookups.keyed_table(self.source.quantities(), ["GRANDEZZA"])

    def units(self) -> DataFrame:
        return lookups.keyed_table(self.source.units(), ["SIGLA_STRUMENTO"])

    # small lookup tables: materialized once, so each join that uses them sees
    # the measured size (an aggregate's estimate alone would block the broadcast)
    def compartments(self) -> DataFrame:
        return self._once("compartments",
                          lambda: lookups.keyed_table(self.source.compartments(), ["COMPARTIMENTO"]))

    def organisations(self) -> DataFrame:
        return self._once("organisations", lambda: lookups.organisations(self.source.organisations()))

    def flag_labels(self) -> DataFrame:
        return self._once("flag_labels", lambda: lookups.flag_descriptions(self.source.flag_quality()))

    # ------------------------------------------------------ datastreams
    def station_series(self) -> DataFrame:
        """J5 (D4): every station with its series; a station without series is
        kept with GRANDEZZA NULL."""
        return self.stations().join(self.series().select(*DS_KEYS, "VERSION"), SITE_KEYS, "left")

    def datastreams(self) -> DataFrame:
        return self._once("datastreams", self._datastreams)

    def mapped_datastreams(self) -> DataFrame:
        """Keys and ids of the datastream catalogue for one pass over the
        observations. A small catalogue is kept (``datastreams``); of a large one
        only the plan of the keys is given: the ids follow from the key, so no row
        has to win over another and nothing is sorted or stored for them, and ids
        that the pass does not use are not computed. The stations' keys are checked
        before, as a join may drop a NULL key ahead of the check."""
        cols = [*DS_KEYS, "datastream_key", "datastream_id", "obs_hash_state"]
        size = input_bytes(self.source.stations())
        if size is None or size <= KEPT_BYTES:
            return self.datastreams().select(*cols)
        st = lookups.key_rows(self._station_rows(), SITE_KEYS).select(*SITE_KEYS)
        if not self._checked:
            st.count()
            self._checked = True
        se = lookups.key_rows(self.source.series(), DS_KEYS, strict=False).select(*DS_KEYS)
        ds = (se.distinct().join(bounded_hash(st.distinct(), KEY_BYTES * size), SITE_KEYS, "left_semi")
              .join(bounded_broadcast(self.quantities().select("GRANDEZZA", "SIGLA_STRUMENTO")), "GRANDEZZA")
              .join(bounded_broadcast(self.units().select("SIGLA_STRUMENTO")), "SIGLA_STRUMENTO"))
        ds = (ds.withColumn("datastream_key", key_text(*DS_KEYS))
              .withColumn("_h_ds", ids.fnv_hash("datastream_key"))
              .withColumn("datastream_id", ids.slot_id(F.col("_h_ds"), ids.DATASTREAM_OFFSET))
              .withColumn("obs_hash_state", ids.fnv_after_nul("_h_ds")))
        return bounded_hash(ds.select(*cols), KEY_BYTES * size)

    def _datastreams(self) -> DataFrame:
        """Path-A datastream catalogue, one row per mapped datastream.

        station x series (inner) x quantity (J6, inner) x unit (J7, inner)
        x class label (J8, left); keys and ids (F3, F12, D8); the FNV prefix
        state of ``key || NUL`` for observation ids (F13).
        """
        q = self.quantities()
        # each natural key is hashed once, at the grain where it is unique:
        # URIs on the quantity table, thing keys per station, datastream keys
        # per datastream (shared by the datastream and sensor ids, D8)
        q = (q.withColumn("_h_uri", ids.fnv_hash_sql("TIPO_GRANDEZZA"))
             .withColumn("observed_property_id", ids.slot_id(F.col("_h_uri"), ids.OBSERVED_PROPERTY_OFFSET))
             .drop("_h_uri"))
        u = self.units().select("SIGLA_STRUMENTO", F.col("UDM").alias("uom_symbol"),
                                F.col("DESCRIZIONE_UDM").alias("uom_name"))
        labels = lookups.class_labels(self.source.instruments())
        st = self.stations().withColumnRenamed("thing_hash", "_h_thing")
        ds = (st.join(self.series().select(*DS_KEYS, "VERSION"), SITE_KEYS)
              .join(bounded_broadcast(q), "GRANDEZZA")
              .join(bounded_broadcast(u), "SIGLA_STRUMENTO")
              .join(bounded_broadcast(labels), "SIGLA_STRUMENTO", "left"))
        ds = (ds.withColumn("datastream_key", key_text(*DS_KEYS))
              .withColumn("_h_ds", ids.fnv_hash("datastream_key")))
        return (ds.withColumn("thing_id", ids.slot_id(F.col("_h_thing"), ids.THING_OFFSET))
                .withColumn("datastream_id", ids.slot_id(F.col("_h_ds"), ids.DATASTREAM_OFFSET))
                .withColumn("sensor_id", ids.slot_id(F.col("_h_ds"), ids.SENSOR_OFFSET))
                .withColumn("obs_hash_state", ids.fnv_after_nul("_h_ds"))
                .withColumn("quantity_label", quantity_label("TIPO_GRANDEZZA"))
                .drop("_h_thing", "_h_ds"))
