"""What must not grow with the tables: Python passes, sorts of scanned pieces, tasks for empty frames."""

import csv
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.functions import ids
from tidewater.plans.catalog import Catalog
from tidewater.sources.driver import DriverTables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hash_goes_on_with_nul_without_python(spark):
    df = spark.createDataFrame([("DS-KEY",), ("",), ("è€",), ("x" * 300,)], "p string").withColumn("h", ids.fnv_hash("p"))
    df = df.withColumn("q", F.concat("p", F.expr("chr(0)")))
    got = df.select(ids.fnv_after_nul("h").alias("a"), ids.fnv_hash("q").alias("b")).collect()
    assert len(got) == 4 and all(r.a == r.b for r in got)
    assert spark.range(1).select(F.lit(None).cast("long").alias("h")).select(ids.fnv_after_nul("h").alias("a")).first().a is None


def test_datastream_keys_take_one_python_pass(spark):
    assert plan_of(Catalog(DriverTables(spark, SF_SMALL))._datastreams()).split("InMemoryRelation")[0].count("ArrowEvalPython") == 1


def test_sites_are_dealt_out_before_they_unfold(spark):
    src = DriverTables(spark, SF_SMALL)
    for df in (src.series(), src.series_b(), src.stations()):
        scan = plan_of(df).split("customer.parquet")[0].rsplit("Exchange", 1)[-1]
        assert "REPARTITION_BY_COL" in scan and not re.search("Join|Window", scan)


def test_no_rows_need_no_tasks(spark, tmp_path):
    from pyspark.sql import types as T

    from tidewater.session import empty
    from tidewater.sinks.tables import ObservationTable
    from tidewater.sources.hadoop import list_files
    schema = T.StructType.fromDDL("datastream_key string, phenomenon_time string, m map<string,array<int>>")
    for df in (empty(spark, schema), empty(spark, "a string, m map<string,array<int>>"),
               ObservationTable(spark, f"{tmp_path}/none", schema).read(), list_files(spark, f"{tmp_path}/none")):
        assert df.collect() == [] and "RDD" not in plan_of(df) and "LocalTableScan" in plan_of(df)
    assert empty(spark, schema).dtypes == [(f.name, f.dataType.simpleString()) for f in schema]


def test_district_cells_go_out_as_they_are(spark, tmp_path):
    from tidewater.sinks import districts
    rows = [("A", 'say "x"; y', None, 0), ("A", None, "è\nz", 1), (None, "", "p", 2), ("A", "q", "r", 5)]
    raw = spark.createDataFrame(rows, "d string, v string, w string, _ord long")
    found = [r.n_rows for r in districts.write_district_files(raw, str(tmp_path), 4, ["d", "v", "w"]).collect()]
    assert sorted(found) == [1, 1, 2]
    read = lambda name: list(csv.reader(open(f"{tmp_path}/{name}", encoding="utf-8-sig", newline=""), delimiter=";"))
    assert read("Distretto A/osservazioni 000000000.csv") == [["d", "v", "w"], ["A", 'say "x"; y', ""], ["A", "", "è\nz"]]
    assert read("Distretto UNKNOWN/osservazioni 000000000.csv") == [["d", "v", "w"], ["", "", "p"]]
    import pyarrow as pa
    assert list(districts.cells(pa.array(["a", None]))) == ["a", None]


class SiteRows:
    """Station and series rows of a test beside the driver's lookup tables."""

    def __init__(self, spark, stations, series):
        self.lookups = DriverTables(spark, SF_SMALL)
        site = "Compartimento string, ALIAS_BACINO string, ALIAS_STAZIONE string"
        self.rows = (spark.createDataFrame([(*s, "9,1", "45,2", "10.5", i) for i, s in enumerate(stations)],
                                           f"{site}, X_LONG string, Y_LAT string, Z_MSLM string, _ord long"),
                     spark.createDataFrame([(*s, "1", i) for i, s in enumerate(series)],
                                           f"{site}, GRANDEZZA string, VERSION string, _ord long"))

    def stations(self):
        return self.rows[0]

    def series(self):
        return self.rows[1]

    def __getattr__(self, name):
        return getattr(self.lookups, name)


def test_one_pass_plans_the_keys_of_a_large_catalogue(spark, monkeypatch):
    from tidewater.plans import catalog
    from tidewater.plans.registry import datastream_qualifiers
    here = ("ASIA", "INDIA", "S1")
    src = SiteRows(spark, [here, here, ("ASIA", "INDIA ", "S2"), ("ASIA", "CHINA", "S1")],
                   [(*here, "view"), (*here, "view"), (*here, "error"), ("ASIA", "INDIA", " S2", "purchase"),
                    ("ASIA", None, "S2", "view"), ("ASIA", "INDIA", "S9", "view"), ("ASIA", "CHINA", "S1", "unheard of")])
    want = sorted(map(tuple, Catalog(src).mapped_datastreams().collect()))
    assert [r[4] for r in want] == ["ASIA-INDIA-S1-view", "ASIA-INDIA-S2-purchase"]
    kept = datastream_qualifiers(spark, SF_SMALL)
    assert "InMemoryTableScan" in plan_of(kept)
    monkeypatch.setattr(catalog, "KEPT_BYTES", -1)
    got = Catalog(src).mapped_datastreams()
    assert sorted(map(tuple, got.collect())) == want
    plan = plan_of(got.select(*catalog.DS_KEYS, "datastream_key"))
    assert not re.search("ArrowEvalPython|Window|InMemoryTableScan", plan)
    monkeypatch.delitem(spark._tidewater_catalogs, SF_SMALL)
    planned = datastream_qualifiers(spark, SF_SMALL)
    assert "ArrowEvalPython" not in plan_of(planned)
    assert sorted(map(tuple, planned.collect())) == sorted(map(tuple, kept.collect())) != []


def test_a_blank_station_key_fails_a_planned_catalogue_too(spark, monkeypatch):
    import pytest

    from tidewater.plans import catalog
    monkeypatch.setattr(catalog, "KEPT_BYTES", -1)
    for blank in (None, " "):
        with pytest.raises(Exception, match="blank key"):
            Catalog(SiteRows(spark, [("ASIA", "INDIA", "S1"), ("ASIA", "INDIA", blank)], [("ASIA", "INDIA", "S1", "view")])).mapped_datastreams()


def test_a_hash_table_of_one_task_is_bounded(spark):
    from tidewater.operators.joins import bounded_hash, input_bytes
    a, n = spark.range(9), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "shuffle_hash" in str(bounded_hash(a, 100 * n, 100)._jdf.queryExecution().logical())
    assert "shuffle_hash" not in str(bounded_hash(a, 101 * n, 100)._jdf.queryExecution().logical())
    wide = a.join(a.withColumnRenamed("id", "b"))
    assert input_bytes(wide) == 2 * input_bytes(a)


def test_only_one_column_of_own_text_checks_crosses_to_a_large_catalogue(spark, monkeypatch):
    from tidewater.plans import catalog, mapping
    monkeypatch.setattr(catalog, "KEPT_BYTES", -1)
    mapped = mapping.map_all(Catalog(DriverTables(spark, SF_SMALL)), once=True).select("reject_reason", "datastream_key")
    dealt = next(x for x in plan_of(mapped).split("Exchange hashpartitioning(COMPARTIMENTO")[1:] if "events.parquet" in x)
    top = re.search(r"Project \[(.*)", dealt).group(1).split("CASE")[0]
    assert "GRANDEZZA#" in top and not re.search("year#|result#| VALORE#", top)


def test_hour_text_is_split_as_by_split_part(spark):
    from tidewater.functions.time import split_hour
    t = spark.createDataFrame([(x,) for x in ("7:05", "24:00", "1:2:3", ":", ":5", "5:", "a:b", "::4", "12", "", " 8 : 9 ", "-1:60",
                                              "9:é", "99999999999:1", None)], "t string")
    old = [F.when(F.instr("t", ":") > 0, F.split_part("t", F.lit(":"), F.lit(i)).try_cast("int")) for i in (1, 2)]
    got = t.select(*split_hour("t"), *old).collect()
    assert len(got) == 15 and all((r[0], r[1]) == (r[2], r[3]) for r in got)


def test_files_are_broadcast_by_what_their_rows_unfold_to(spark, tmp_path):
    from tidewater.operators import joins
    spark.range(400_000).select("id", F.lit("a").alias("name"), F.lit(None).cast("double").alias("v")).coalesce(1).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t").select("id", "name")
    hinted = lambda df, most: "hint" in joins.bounded_broadcast(df, most)._jdf.queryExecution().logical().toString().lower()
    bound = 4 * joins.estimated_bytes(t)
    assert joins.SMALL_FILE_BYTES < joins.estimated_bytes(t) and bound < 400_000 * 40
    assert not hinted(t, bound)                                          # the files fit the bound, their rows do not
    assert hinted(t, 400_000 * 44) and hinted(t.filter("id < 5"), bound)
    assert joins.file_rows_bytes(t) == 400_000 * (2 * 8 + 8 + 20)
    for other in (t.distinct(), t.join(t.select("id"), "id"), spark.range(9)):
        assert joins.file_rows_bytes(other) is None                      # not counted: that would run the plan twice


def test_observations_meet_many_stations_by_shuffle(spark, tmp_path):
    from tidewater.operators import joins
    n = 1_000_000                                        # 72 MB as rows, a few MB as a file
    spark.range(n).select(F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
                          F.lit(1.5).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    src = DriverTables(spark, str(tmp_path))
    customers = src.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    assert 1 << 20 < joins.estimated_bytes(customers) < joins.DEFAULT_BROADCAST_BYTES
    events = spark.createDataFrame([(5, 7), (6, n - 1), (7, n), (8, None), (9, 7)], "event_id long, user_id long").selectExpr(
        "event_id", "timestamp'2024-01-01 00:00:00' AS ts", "user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 2}' AS props")
    raw = src.raw_observations(events)
    hinted = [h.split("Relation", 1)[1].split("]")[0] for h in raw._jdf.queryExecution().analyzed().toString().split("ResolvedHint")[1:]]
    assert len(hinted) == 2 and not any("c_custkey" in h for h in hinted)
    assert [tuple(r) for r in raw.select("_ord", "ALIAS_STAZIONE").orderBy("_ord").collect()] == [
        (5, "Customer#000000007"), (6, f"Customer#{n - 1:09d}"), (7, None), (8, None), (9, "Customer#000000007")]
