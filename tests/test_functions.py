"""Scalar expressions: decimal commas, keys, periods, intervals, durations,
local time to UTC, ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import ids, text, time as T


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("v,expected", [
    ("12,5", 12.5), ("1.234,5", 1234.5), ("1,234,567", None), ("12.5", 12.5), ("-9999", -9999.0),
    ("NA", None), ("", None), ("  7,25 ", 7.25), ("abc", None), (None, None), ("1\u00a0234,5", 1234.5), ("1 234,5", None)])
def test_decimal_comma_lenient(spark, v, expected):
    assert one(spark, text.decimal_comma_lenient("x"), v) == expected


@pytest.mark.parametrize("v,expected", [("16,0667", "16.066700"), ("105.5", "105.500000"), ("x", None)])
def test_decimal_comma_strict(spark, v, expected):
    r = one(spark, text.decimal_comma_strict("x"), v)
    assert (str(r) if r is not None else None) == expected


def test_key_text_nulls_and_norm(spark):
    df = spark.createDataFrame([("BA", None, " s ", "nan")], "a string, b string, c string, d string")
    r = df.select(text.key_text("a", "b").alias("k"), text.norm_key_part("c").alias("n"),
                  text.norm_key_part("d").alias("m"), text.optional_text("c").alias("o")).first()
    assert (r.k, r.n, r.m, r.o) == ("BA-null", "S", "", "s")


@pytest.mark.parametrize("p,value,unit", [
    ("P1D", 1, "days"), ("PT1H", 1, "hours"), ("PT36H", 36, "hours"), ("P1Y", 1, "years"), ("P2M", 2, "months"),
    ("P1YT1H", None, None), ("P0D", None, None), ("daily", None, None), ("PT90M", 90, "minutes"),
    ("P1DT1H", 25, "hours"), ("PT30S", 30, "seconds"), ("pt2h", 2, "hours"), (None, None, None), ("P", None, None)])
def test_iso_period(spark, p, value, unit):
    df = spark.createDataFrame([(p,)], "x string")
    r = T.add_iso_period(df, "x", "v", "u").first()
    assert (r.v, r.u) == (value, unit)


@pytest.mark.parametrize("s,expected", [
    (0, "0s"), (59, "59s"), (61, "1m 1s"), (3600, "1h 0m 0s"), (86400, "1d"), (90061, "1d 1h 1m 1s"),
    (365 * 86400 + 2 * 86400 + 5, "1y + 2d"), (-61, "-1m 1s"), (None, None)])
def test_duration_text(spark, s, expected):
    assert one(spark, T.duration_text("x"), s, "x long") == expected


@pytest.mark.parametrize("v,dur", [
    ("2024-01-01T00:00:00Z", 0), ("2024-01-01T00:00:00Z/2024-01-02T00:00:00Z", 86400),
    ("2024-01-02T00:00:00Z/2024-01-01T00:00:00Z", 86400), ("P1D/2024-01-02T00:00:00Z", None),
    ("bad", None), ("2024-01-01T00:00:00/2024-01-01T01:00:00", 3600), ("2024-01-01T01:00:00+01:00", 0),
    (None, None), ("", None)])
def test_parse_interval(spark, v, dur):
    s, e, d = T.parse_interval("x")
    assert one(spark, d, v) == dur


def test_normalize_instant(spark):
    assert one(spark, T.normalize_instant("x"), "2024-01-01T00:00:00") == "2024-01-01T00:00:00Z"
    assert one(spark, T.normalize_instant("x"), "2024-01-01T00:00:00-02:00") == "2024-01-01T00:00:00-02:00"


@pytest.mark.parametrize("y,mo,d,h,mi,utc", [
    (1930, 1, 1, 9, 0, dt.datetime(1930, 1, 1, 8, 0)),
    (1890, 6, 1, 9, 0, dt.datetime(1890, 6, 1, 8, 10, 4)),          # local mean time before 1893
    (2021, 3, 28, 2, 30, dt.datetime(2021, 3, 28, 1, 30)),          # spring gap moves forward
    (2021, 10, 31, 2, 30, dt.datetime(2021, 10, 31, 0, 30)),        # overlap: earlier offset
    (2024, 2, 30, 10, 0, None), (2024, 1, 1, 24, 0, None)])
def test_local_to_utc(spark, y, mo, d, h, mi, utc):
    df = spark.createDataFrame([(y, mo, d, h, mi)], "y int, mo int, d int, h int, mi int")
    r = df.select(T.local_to_utc(T.local_wall_time("y", "mo", "d", "h", "mi"), "Europe/Rome").alias("t")).first().t
    assert r == utc


@pytest.mark.parametrize("hour,ok", [("09:05", (9, 5)), ("0905", (None, None)), ("x:1", (None, 1)), ("24:00", (24, 0))])
def test_split_hour(spark, hour, ok):
    h, m = T.split_hour("x")
    r = spark.createDataFrame([(hour,)], "x string").select(h.alias("h"), m.alias("m")).first()
    assert (r.h, r.m) == ok


def _fnv_py(s: str) -> int:
    h = 0xCBF29CE484222325
    for u in [int.from_bytes(s.encode("utf-16-be")[i:i + 2], "big") for i in range(0, len(s.encode("utf-16-be")), 2)]:
        h = ((h ^ u) * 0x100000001B3) & (2 ** 64 - 1)
    return h - 2 ** 64 if h >= 2 ** 63 else h


KEYS = ["", "abc", "BA-OFANTO-CANOSA-P", "città àèìòù", "a\x00b", "emoji 😀 x", "x" * 300]


def test_fnv_udf_sql_and_python_agree(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    got = {r.k: (r.u, r.s) for r in df.select("k", ids.fnv_hash("k").alias("u"), ids.fnv_hash_sql("k").alias("s")).collect()}
    for k in KEYS:
        assert got[k][0] == got[k][1] == _fnv_py(k), k


def test_fnv_continue_equals_full_hash(spark):
    df = spark.createDataFrame([("DS-KEY", "2024-01-01T00:00:00Z")], "p string, t string")
    df = df.withColumn("p0", F.concat("p", F.expr("chr(0)")))
    df = df.withColumn("st", ids.fnv_state("p0")).withColumn("full", F.concat("p0", "t"))
    r = df.select(ids.observation_id("st", "t").alias("a"), ids.observation_id_from_hash(ids.fnv_hash("full")).alias("b")).first()
    assert r.a == r.b
    assert 6_000_000_000 <= r.a < 6_000_000_000 + 2 ** 52


def test_entity_id_range(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    for r in df.select(ids.entity_id("k", ids.THING_OFFSET).alias("i")).collect():
        assert 1_000_000_000 <= r.i < 2_000_000_000


def test_text_helpers(spark):
    df = spark.createDataFrame([("mm", "millimetri", "a, b ,c", " P00 ", 'a:b/c\\d<e>f"g|h?i*j')],
                               "s string, n string, roles string, flag string, key string")
    r = df.select(text.unit_text("s", "n").alias("u"), text.unit_text("s", "s").alias("same"),
                  text.unit_text(F.lit(""), F.lit(" ")).alias("empty"),
                  text.unit_text(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("missing"),
                  text.role_list("roles").alias("roles"), text.qualifier_codes("flag").alias("q"),
                  text.qualifier_codes(F.lit(" ")).alias("q0"), text.path_safe("key").alias("p"),
                  text.path_safe(F.lit(None).cast("string")).alias("pn"),
                  text.missing_or_empty(F.lit("  ")).alias("me"),
                  text.quantity_label(F.lit("http://codes.wmo.int/wmdr/ObservedVariableAtmosphere/210")).alias("ql"),
                  text.quantity_label(F.lit("urn:x")).alias("ql2")).first()
    assert r.u == "mm (millimetri)" and r.same == "mm" and r.empty == "(empty)" and r.missing == "(missing)"
    assert r.roles == ["a", "b", "c"] and r.q == ["P00"] and r.q0 is None
    assert r.p == "a_b_c_d_e_f_g_h_i_j" and r.pn == "null" and r.me == "(empty)"
    assert r.ql == "Amount of precipitation" and r.ql2 == "urn:x"


def test_property_code(spark):
    df = spark.createDataFrame([({"code": "c1"},), ({"variableCode": "v", "code": "c"},)], "p map<string,string>")
    assert sorted(r.c for r in df.select(text.property_code("p").alias("c")).collect()) == ["c1", "v"]
