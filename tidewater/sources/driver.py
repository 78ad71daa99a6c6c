"""Binding of the observation model to the driver's parquet tables.

The driver ships a TPC-H-like star schema plus an ``events`` table. This module
presents it in the shape the ingestion pipeline reads: raw observation rows as
text (like the district CSV files), a station table, a series catalogue and the
lookup tables. Every fact-sized frame is derived from the parquet tables by
Spark; only the small reference tables (quantities, instruments, units,
quality flags, segment registry, general metadata) are fixed values, exactly
like the reference's lookup CSV files.

Binding (one row per event is one observation):

* compartment = region name, basin = nation name, station = customer name,
  quantity = event type; the customer is ``events.user_id``;
* the compartment table lists the regions whose name is a single word;
* organisations come from ``nation`` (fixed size, 25 rows);
* a station carries the quantities its market segment registers
  (``SEGMENT_QUANTITIES``), so some events belong to unknown series;
* raw text is spoiled by a fixed rule on ``event_id % 97`` so that validation
  has work: 0 -> 30 February, 1 -> hour 24:00, 2 -> decimal comma in the value,
  3 -> blank value, 4 -> hour without ``:``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

URI_PRECIPITATION = "http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/210"
URI_AIR_TEMPERATURE = "http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/224"

# General metadata (single row).
METADATA_COLUMNS = ["TerritoryName", "TimeZone", "ApplicationArea", "Domain", "LevelOfData", "DataPolicy",
                    "licence", "Disclaimer", "DataSource", "Funding", "ContactPoint", "Reference_Author",
                    "Reference_Title"]
METADATA_ROW = ("Italia", "Europe/Rome", "Hydrology", "Meteorology", "L1", "Open", "CC BY 4.0",
                "Historical data digitised from printed yearbooks", "Digitised hydrological yearbooks",
                "National research programme", "data desk", "Hydrographic Service", "Hydrological Yearbook")

# Quantity table, keyed by GRANDEZZA (= event_type).
QUANTITY_COLUMNS = ["SIGLA_STRUMENTO", "TIPO_GRANDEZZA", "SAMPLE_MEDIUM", "GRANDEZZA", "INTERPOLATION_TYPE",
                    "AGGREGATION_PERIOD", "DESCRIZIONE_GRANDEZZA"]
QUANTITY_ROWS = [
    ("P", URI_PRECIPITATION, "Air", "view", "Total", "P1D", "Daily precipitation"),
    ("P", URI_PRECIPITATION, "Air", "click", "Maximum", "PT3H", "Maximum precipitation in 3 hours"),
    ("T", URI_AIR_TEMPERATURE, "Air", "purchase", "Average", "P1Y", "Yearly mean air temperature"),
    ("T", URI_AIR_TEMPERATURE, "Air", "signup", "Minimum", "PT36H", "Minimum air temperature over 36 hours"),
    ("I", "urn:quantity:water-level", "Water", "error", "Continuous", "daily", "Water level"),
]

# Instrument types (several per class).
INSTRUMENT_COLUMNS = ["SIGLA_STRUMENTO", "CATEGORIA_STRUMENTO", "TIPO_STRUMENTO_ANNALE",
                      "DESCRIZIONE_TIPO_STRUMENTO_ANNALE"]
INSTRUMENT_ROWS = [
    ("P", "Pluviometro", "PLV", "Pluviometro ordinario"),
    ("P", "Pluviografo", "PLG", "Pluviografo registratore"),
    ("T", "Termometro", "TMM", "Termometro a massima e minima"),
    ("T", "Termografo", "TMG", "Termografo registratore"),
    ("I", "Idrometro", "IDR", "Idrometro a lettura diretta"),
]

# Units per instrument class; class I has none.
UNIT_COLUMNS = ["SIGLA_STRUMENTO", "UDM", "DESCRIZIONE_UDM"]
UNIT_ROWS = [
    ("P", "mm", "millimetri"),
    ("T", "°C", "gradi Celsius"),
]

# Quality flags; codes ending in 3, 4, 5 are absent on purpose.
FLAG_COLUMNS = ["SIGLA_STRUMENTO", "TIPO_VALORE", "FLAG_VALORE", "DESCRIZIONE_FLAG"]
FLAG_ROWS = [
    ("P", "Giornaliero", "V00", "Valore validato"),
    ("P", "Massimo", "V00", "Valore validato"),
    ("P", "Giornaliero", "V01", "Valore stimato"),
    ("P", "Giornaliero", "V02", "Valore ricostruito"),
    ("P", "Massimo", "C00", "Valore validato"),
    ("P", "Massimo", "C01", "Valore stimato"),
    ("T", "Media", "P00", "Valore validato"),
    ("T", "Minima", "P00", "Valore validato"),
    ("T", "Media", "P01", "Valore incerto"),
    ("T", "Media; oraria", "P02", "Valore orario"),
    ("T", "Minima", "S00", "Valore validato"),
    ("T", "Minima", "S02", "Valore da strumento di riserva"),
    ("I", "Livello", "E00", "Valore validato"),
    ("I", "Livello", "E01", 'Valore "provvisorio"'),
    ("", "Livello", "E02", "Strumento non indicato"),
]

# Quantities registered per customer market segment, with
# optional series-level overrides (interpolation, period, spacing, unit).
# HOUSEHOLD stations measure precipitation only (a cascade delete of that
# property leaves them without datastreams).
SEGMENT_COLUMNS = ["c_mktsegment", "GRANDEZZA", "VERSION", "INTERPOLATION_TYPE", "AGGREGATION_PERIOD",
                   "INTENDED_TIME_SPACING", "INTENDED_TIME_SPACING_UNIT"]
SEGMENT_ROWS = [
    ("AUTOMOBILE", "view", "1", None, None, None, None),
    ("AUTOMOBILE", "click", "1", None, None, None, None),
    ("AUTOMOBILE", "purchase", "1", None, None, None, None),
    ("AUTOMOBILE", "signup", "2", None, None, None, None),
    ("BUILDING", "view", "1", "Total", "PT12H", "12", "hours"),
    ("BUILDING", "click", "1", None, None, None, None),
    ("BUILDING", "purchase", "1", None, None, None, None),
    ("BUILDING", "error", "1", None, None, None, None),
    ("FURNITURE", "view", "2", None, None, None, None),
    ("FURNITURE", "click", "1", None, "P1DT1H", None, None),
    ("FURNITURE", "signup", "1", None, None, None, None),
    ("FURNITURE", "error", "1", None, None, None, None),
    ("HOUSEHOLD", "view", "1", None, None, None, None),
    ("HOUSEHOLD", "click", "1", "Maximum", "P0D", None, None),
    ("HOUSEHOLD", "error", "1", None, None, None, None),
    ("MACHINERY", "click", "1", None, None, None, None),
    ("MACHINERY", "purchase", "1", None, None, None, None),
    ("MACHINERY", "signup", "1", None, None, None, None),
    ("MACHINERY", "error", "2", None, "PT90M", "90", "minutes"),
]

OBSERVATION_COLUMNS = ["COMPARTIMENTO", "ALIAS_BACINO", "ALIAS_STAZIONE", "GRANDEZZA", "PARTE_ANNALE", "PAGINA",
                       "TABELLA_ORDINE", "NOME_STAZIONE_ANNALE", "NOME_BACINO_ANNALE", "TIPO_STRUMENTO_ANNALE",
                       "QUOTA_STRUMENTO_ANNALE", "ANNO", "MESE", "GIORNO", "ORA", "VALORE", "FLAG_VALORE",
                       "SIGLA_ENTE_COMPILATORE", "NOME_COMPILATORE"]


def _sql_text(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fixed(spark: SparkSession, cols: list[str], rows: list[tuple]) -> DataFrame:
    """A fixed lookup table as an inline VALUES relation: Catalyst knows its
    exact size, so joins with it are broadcast without a hint."""
    values = ", ".join("(" + ", ".join(_sql_text(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"`{c}`" for c in cols)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _decimal_text(units: Column, scale_digits: int, sep: str) -> Column:
    """Exact decimal text of an integer count of 10^-scale units."""
    a = F.abs(units)
    den = 10 ** scale_digits
    return F.concat(F.when(units < 0, F.lit("-")).otherwise(F.lit("")),
                    F.floor(a / den).cast("long").cast("string"), F.lit(sep),
                    F.lpad((a % den).cast("string"), scale_digits, "0"))


class DriverTables:
    """Reads the driver's parquet tables from ``sf_dir`` and derives the
    ingestion inputs from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---------------------------------------------------------------- lookups
    def general_metadata(self) -> DataFrame:
        return _fixed(self.spark, METADATA_COLUMNS, [METADATA_ROW])

    def quantities(self) -> DataFrame:
        return _fixed(self.spark, QUANTITY_COLUMNS, QUANTITY_ROWS)

    def instruments(self) -> DataFrame:
        return _fixed(self.spark, INSTRUMENT_COLUMNS, INSTRUMENT_ROWS)

    def units(self) -> DataFrame:
        return _fixed(self.spark, UNIT_COLUMNS, UNIT_ROWS)

    def flag_quality(self) -> DataFrame:
        return _fixed(self.spark, FLAG_COLUMNS, FLAG_ROWS)

    def segment_registry(self) -> DataFrame:
        return _fixed(self.spark, SEGMENT_COLUMNS, SEGMENT_ROWS)

    def compartments(self) -> DataFrame:
        """COMPARTIMENTO, NOME_COMPARTIMENTO: regions named by one word."""
        return (self.table("region").filter(~F.col("r_name").contains(" "))
                .select(F.col("r_name").alias("COMPARTIMENTO"),
                        F.concat(F.lit("Distretto "), F.col("r_name")).alias("NOME_COMPARTIMENTO")))

    def organisations(self) -> DataFrame:
        """Editor organisations, one per nation (fixed size)."""
        n = self.table("nation")
        role = (F.when(F.col("n_regionkey") == 0, "editor,publisher")
                .when(F.col("n_regionkey") == 1, "owner")
                .when(F.col("n_regionkey") == 2, "editor, pointOfContact")
                .when(F.col("n_regionkey") == 3, "publisher")
                .otherwise("custodian"))
        email = F.when(F.col("n_regionkey") == 4, F.lit("")).otherwise(
            F.concat(F.lower(F.col("n_name")), F.lit("@example.org")))
        general = (F.when(F.col("n_nationkey") % 10 == 0, "Y").when(F.col("n_nationkey") == 5, "y")
                   .otherwise("N"))
        return n.select(
            F.concat(F.lit("ENTE"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("SIGLA_ENTE_COMPILATORE"),
            F.concat(F.lit("Ufficio "), F.col("n_name")).alias("NOME_ENTE_COMPILATORE"),
            role.alias("RUOLO_ENTE_COMPILATORE"),
            email.alias("EmailpuntoContatto"),
            F.lit("partner").alias("RUOLO_PROGETTO"),
            general.alias("GENERAL"))

    def _customer_sites(self, dealt: bool = False) -> DataFrame:
        """Customers with nation and region. ``dealt``: spread over all tasks while
        they are still narrow, so that what is made of them (several series each,
        ordered by key in every task) is bounded by the number of tasks and not by
        what one piece of a well compressed file unfolds to."""
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        c = c.repartition("c_custkey", "c_name") if dealt else c
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey))

    @staticmethod
    def _elevation_text() -> Column:
        cents = F.round(F.col("c_acctbal") * 100).cast("long")
        return F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(_decimal_text(cents, 2, "."))

    def stations(self) -> DataFrame:
        """Compartimento, ALIAS_BACINO, ALIAS_STAZIONE, X_LONG, Y_LAT (decimal
        comma), Z_MSLM (decimal point, blank when unknown), plus ``_ord``."""
        lon = F.lit(6500) + (F.col("c_custkey") % 1301) * 5
        lat = F.lit(36600) + (F.col("c_custkey") % 997) * 8
        return self._customer_sites(dealt=True).select(
            F.col("r_name").alias("Compartimento"), F.col("n_name").alias("ALIAS_BACINO"),
            F.col("c_name").alias("ALIAS_STAZIONE"),
            _decimal_text(lon, 3, ",").alias("X_LONG"), _decimal_text(lat, 3, ",").alias("Y_LAT"),
            self._elevation_text().alias("Z_MSLM"),
            F.col("c_custkey").alias("_ord"))

    def station_revisions(self) -> DataFrame:
        """Station rows re-issued once per order of the station's customer
        (repeated keys; ``_ord`` = order key, elevation from the order total)."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        sites = self._customer_sites().select("c_custkey", "c_name", "n_name", "r_name")
        cents = F.round(F.col("o_totalprice") * 100).cast("long")
        return (o.join(sites, o.o_custkey == sites.c_custkey)
                .select(F.col("r_name").alias("COMPARTIMENTO"), F.col("n_name").alias("ALIAS_BACINO"),
                        F.col("c_name").alias("ALIAS_STAZIONE"), _decimal_text(cents, 2, ".").alias("Z_MSLM"),
                        F.col("o_orderkey").alias("_ord")))

    def series(self) -> DataFrame:
        """Series catalogue: one row per (station, registered quantity)."""
        sites = self._customer_sites(dealt=True)
        reg = self.segment_registry()
        q = self.quantities().select("GRANDEZZA", "TIPO_GRANDEZZA")
        return (sites.join(F.broadcast(reg), "c_mktsegment").join(F.broadcast(q), "GRANDEZZA")
                .select(F.col("r_name").alias("COMPARTIMENTO"), F.col("c_name").alias("ALIAS_STAZIONE"),
                        F.col("n_name").alias("ALIAS_BACINO"), "TIPO_GRANDEZZA", "GRANDEZZA", "VERSION",
                        "INTERPOLATION_TYPE", "AGGREGATION_PERIOD", "INTENDED_TIME_SPACING",
                        "INTENDED_TIME_SPACING_UNIT", F.col("c_custkey").alias("_ord")))

    def series_b(self) -> DataFrame:
        """Series file as the path-B loader sees it: the FURNITURE stations
        write the compartment in lower case (keys are normalised, F4) and the
        BUILDING stations leave the basin blank (station-level defaults, J12)."""
        sites = self._customer_sites(dealt=True)
        reg = self.segment_registry()
        q = self.quantities().select("GRANDEZZA", "TIPO_GRANDEZZA")
        seg = F.col("c_mktsegment")
        return (sites.join(F.broadcast(reg), "c_mktsegment").join(F.broadcast(q), "GRANDEZZA")
                .select(F.when(seg == "FURNITURE", F.lower("r_name")).otherwise(F.col("r_name")).alias("COMPARTIMENTO"),
                        F.col("c_name").alias("ALIAS_STAZIONE"),
                        F.when(seg == "BUILDING", F.lit("")).otherwise(F.col("n_name")).alias("ALIAS_BACINO"),
                        "TIPO_GRANDEZZA", "GRANDEZZA", "VERSION", "INTERPOLATION_TYPE", "AGGREGATION_PERIOD",
                        "INTENDED_TIME_SPACING", "INTENDED_TIME_SPACING_UNIT", F.col("c_custkey").alias("_ord")))

    def lineitem_observations(self) -> DataFrame:
        """Second fact with repeated times: series (l_suppkey, l_returnflag),
        time l_shipdate (day level), value l_extendedprice; the remaining
        columns give a total arrival order."""
        return self.table("lineitem").select(
            "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber",
            "l_partkey", "l_quantity", "l_discount", "l_tax", "l_linestatus")

    # ------------------------------------------------------------------ facts
    def events_schema(self):
        return self.table("events").schema

    def raw_observations(self, events: DataFrame | None = None) -> DataFrame:
        """The 19 text columns of an observation file plus ``_ord`` (arrival
        order, = event_id). ``events`` replaces the events table (a streaming
        micro-batch, say)."""
        e = (self.table("events") if events is None else events).select(
            "event_id", "ts", "user_id", "event_type", "value", "props")
        # events meet the customer projection first: its broadcast is decided on
        # the customer scan's own size (fact-side shuffle only when it is big),
        # then nation and region (25 / 5 rows) are attached by broadcast
        from tidewater.operators.joins import bounded_broadcast
        c = bounded_broadcast(self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"))
        n = F.broadcast(self.table("nation").select("n_nationkey", "n_name", "n_regionkey"))
        r = F.broadcast(self.table("region").select("r_regionkey", "r_name"))
        k = F.get_json_object(F.col("props"), "$.k").cast("int")
        spoil = F.col("event_id") % 97
        ts = F.col("ts")
        value_txt = F.format_string("%.2f", F.col("value"))
        inst = (F.when(F.col("event_type").isin("view", "click"),
                       F.when(F.col("k") % 2 == 0, "PLV").otherwise("PLG"))
                .when(F.col("event_type").isin("purchase", "signup"),
                      F.when(F.col("k") % 2 == 0, "TMM").otherwise("TMG"))
                .otherwise("IDR"))
        # outer joins: an event of an unknown customer stays and is rejected as unknown_station
        j = (e.withColumn("k", k).join(c, e.user_id == c.c_custkey, "left")
             .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
        return j.select(
            F.col("r_name").alias("COMPARTIMENTO"), F.col("n_name").alias("ALIAS_BACINO"),
            F.col("c_name").alias("ALIAS_STAZIONE"), F.col("event_type").alias("GRANDEZZA"),
            F.when(F.col("k") % 2 == 0, "I").otherwise("II").alias("PARTE_ANNALE"),
            (F.col("k") % 40 + 10).cast("string").alias("PAGINA"),
            (F.col("k") % 12 + 1).cast("string").alias("TABELLA_ORDINE"),
            F.col("c_name").alias("NOME_STAZIONE_ANNALE"), F.col("n_name").alias("NOME_BACINO_ANNALE"),
            inst.alias("TIPO_STRUMENTO_ANNALE"),
            self._elevation_text().alias("QUOTA_STRUMENTO_ANNALE"),
            F.year(ts).cast("string").alias("ANNO"),
            F.when(spoil == 0, "02").otherwise(F.lpad(F.month(ts).cast("string"), 2, "0")).alias("MESE"),
            F.when(spoil == 0, "30").otherwise(F.lpad(F.dayofmonth(ts).cast("string"), 2, "0")).alias("GIORNO"),
            F.when(spoil == 1, "24:00").when(spoil == 4, F.date_format(ts, "HHmm"))
             .otherwise(F.date_format(ts, "HH:mm")).alias("ORA"),
            F.when(spoil == 2, F.replace(value_txt, F.lit("."), F.lit(",")))
             .when(spoil == 3, F.lit("")).otherwise(value_txt).alias("VALORE"),
            F.concat(F.upper(F.substring("event_type", 1, 1)), F.lit("0"), (F.col("k") % 6).cast("string"))
             .alias("FLAG_VALORE"),
            F.concat(F.lit("ENTE"), F.lpad((F.col("k") % 30).cast("string"), 2, "0")).alias("SIGLA_ENTE_COMPILATORE"),
            F.when(F.col("k") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("Editor "), (F.col("k") % 7).cast("string")))
             .alias("NOME_COMPILATORE"),
            F.col("event_id").alias("_ord"))
