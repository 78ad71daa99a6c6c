"""Statistics, predicates, upserts, write modes and the cascade on small
hand-made entity tables."""

from pyspark.sql import functions as F

from tidewater.operators import cleanup, predicates as P, stats, upsert


def test_geojson_points(spark):
    rows = [(1, '{"type":"Point","coordinates":[10.0,45.0,100.0]}'),
            (2, '{"type":"Point","coordinates":[11.0,46.0]}'),
            (3, '{"type":"Polygon","coordinates":[[[1.0,2.0],[3.0,4.0,5.0],[1.0,2.0]]]}'),
            (4, '{"type":"Point","coordinates":[]}'), (5, None)]
    df = spark.createDataFrame(rows, "id long, g string")
    pts = stats.geojson_points(df, "id", "g")
    b = stats.bbox(pts).first()
    assert (b.n_points, b.north, b.west, b.south, b.east) == (5, 46.0, 1.0, 2.0, 11.0)
    e = stats.elevation_stats(pts, "id").first()
    assert (e.n_elevations, e.min_elevation, e.max_elevation, e.median_elevation) == (2, 5.0, 100.0, 52.5)
    assert e.locations_without_elevation == 3   # ids 2, 4 and 5 (3 has one elevation)


def test_period_stats(spark):
    rows = [(1, "2024-01-01T00:00:00Z/2024-01-02T00:00:00Z"), (2, None), (3, " "), (4, "bad"),
            (5, "2024-01-01T00:00:00Z"), (6, "2024-01-03T00:00:00Z/2024-01-01T00:00:00Z"), (7, "P1D/2024-01-01T00:00:00Z"),
            (8, "2023-12-31T00:00:00Z/2024-01-01T00:00:00Z")]
    r = stats.period_stats(spark.createDataFrame(rows, "id long, t string"), "id", "t").first()
    assert (r.missing, r.unparseable, r.zero_length, r.sampled) == (2, 2, 1, 4)
    assert (r.shortest_id, r.longest_id, r.shortest_s, r.longest_s) == (5, 6, 0, 2 * 86400)
    assert r.median_s == 86400.0 and r.median_text == "1d"   # sorted 0, 86400, 86400, 172800


def test_count_stats_integer_median(spark):
    per = spark.createDataFrame([(1, 0), (2, 3), (3, 4), (4, 4)], "datastream_id long, n_obs long")
    r = stats.count_stats(per, "datastream_id").first()
    assert (r.min_obs, r.min_obs_datastream, r.max_obs, r.max_obs_datastream) == (0, 1, 4, 3)
    assert (r.median_obs, r.empty_datastreams, r.sample_size) == (3, 1, 4)


def test_tallies(spark):
    ds = spark.createDataFrame(
        [({"aggregationPeriod": "P1D"}, "t", ("mm", "mm")), ({"aggregationPeriod": " "}, None, ("", "")),
         ({}, "t", None)],
        "properties map<string,string>, observationType string, unitOfMeasurement struct<name:string,symbol:string>")
    t = {(r.property, r.value): (r.n, r.pct) for r in stats.datastream_tallies(ds).collect()}
    assert t[("aggregationPeriod", "P1D")] == (1, 33.33) and t[("aggregationPeriod", "(empty)")][0] == 1
    assert t[("aggregationPeriod", "(missing)")][0] == 1 and t[("observationType", "(missing)")][0] == 1
    assert t[("unitOfMeasurement", "mm")][0] == 1 and t[("unitOfMeasurement", "(empty)")][0] == 1
    assert t[("unitOfMeasurement", "(missing)")][0] == 1


def test_predicates(spark):
    df = spark.createDataFrame([("a1", {"v": "2", "s": "x"}, 5.0), ("b2", {"v": "x", "s": "y"}, 50.0)],
                               "name string, properties map<string,string>, result double")
    def names(c):
        return sorted(r.name for r in df.filter(c).collect())
    assert names(P.property_equals("v", 2)) == ["a1"]
    assert names(P.property_equals("s", "y")) == ["b2"]
    assert names(P.property_greater_than("v", 1)) == ["a1"]
    assert names(P.property_in("s", "x", "z")) == ["a1"]
    assert names(P.all_of()) == ["a1", "b2"]
    assert names(P.negate(P.any_of(P.name_starts_with("a"), P.result_greater_than(100)))) == ["b2"]
    assert names(P.all_of(P.name_ends_with("2"), P.result_less_than(60))) == ["b2"]


def test_refresh_and_write_modes(spark):
    old = spark.createDataFrame([("k1", "a", "v1"), ("k2", "b", "v1")], "k string, stat string, ver string")
    new = spark.createDataFrame([("k1", None), ("k3", "c")], "k string, stat string")
    r = {x.k: (x.stat, x.ver, x._origin) for x in upsert.refresh(new, old, ["k"]).collect()}
    assert r == {"k1": ("a", "v1", "both"), "k2": ("b", "v1", "old"), "k3": ("c", None, "new")}
    ex = spark.createDataFrame([(1, "d1"), (2, "d2")], "id long, ds string")
    inc = spark.createDataFrame([(2, "d2"), (3, "d2"), (3, "d2")], "id long, ds string")
    assert upsert.apply_write_mode(ex, inc, upsert.NONE, "ds", ["id"]).count() == 5
    assert sorted(x.id for x in upsert.apply_write_mode(ex, inc, upsert.DELETE_BEFORE_UPLOAD, "ds", ["id"]).collect()) == [1, 2, 3, 3]
    assert sorted(x.id for x in upsert.apply_write_mode(ex, inc, upsert.DETERMINISTIC_ID, "ds", ["id"]).collect()) == [1, 2, 3]
    again = upsert.apply_write_mode(ex, ex, upsert.DETERMINISTIC_ID, "ds", ["id"])
    assert again.count() == 2   # replay adds nothing


def test_reconcile_raises(spark):
    exp = spark.createDataFrame([("d", 1)] * 3, "ds string, b long")
    vis = spark.createDataFrame([("d", 1)] * 2, "ds string, b long")
    rep = upsert.reconcile(exp, vis, ["ds", "b"])
    try:
        upsert.assert_reconciled(rep)
        raise AssertionError("expected a mismatch")
    except AssertionError as e:
        assert "rows missing" in str(e)


def test_cascade(spark):
    props = spark.createDataFrame([("u1", "rain"), ("u2", "temp")], "definition string, name string")
    ds = spark.createDataFrame([(10, "d10", "t100", "u1"), (11, "d11", "t100", "u2"), (12, "d12", "t101", "u1")],
                               "datastream_id long, datastream_key string, thing_key string, definition string")
    obs = spark.createDataFrame([(1000, "d10"), (1001, "d11"), (1002, "d12")], "obs_id long, datastream_key string")
    things = spark.createDataFrame([(100, "t100"), (101, "t101"), (102, "t102")], "thing_id long, thing_key string")
    locs = spark.createDataFrame([(200, "t100"), (201, "t101"), (202, "t102")], "location_id long, thing_key string")
    res = cleanup.cascade_by_property_name(props, ds, obs, things, locs, "rain")
    plan = sorted((r.entity, r.iot_id) for r in res.plan.collect())
    assert plan == [("Datastream", 10), ("Datastream", 12), ("Location", 201), ("Observation", 1000),
                    ("Observation", 1002), ("Thing", 101)]
    assert sorted(r.thing_id for r in res.things.collect()) == [100, 102]   # thing without any ds is kept
    counts = {r.entity: r.n for r in cleanup.plan_counts(res).collect()}
    assert counts == {"Observation": 2, "Datastream": 2, "Thing": 1, "Location": 1}
    upd = cleanup.update_by_id(things.withColumn("n", F.lit("a")), "thing_id", 100, {"n": F.lit("b")})
    assert sorted((r.thing_id, r.n) for r in upd.collect()) == [(100, "b"), (101, "a"), (102, "a")]


def test_clashing_ids_keep_keys_apart(spark):
    """Two datastreams and two things forced onto one id: expand, X1, X3 and the
    counts go by key."""
    from tidewater.operators import navigation
    things = spark.createDataFrame([(1, "ta"), (1, "tb")], "thing_id long, thing_key string")
    ds = spark.createDataFrame([(5, "a", "ta", "u1"), (5, "b", "tb", "u2")],
                               "datastream_id long, datastream_key string, thing_key string, definition string")
    obs = spark.createDataFrame([(9, "a", 5), (9, "b", 5), (8, "b", 5)], "obs_id long, datastream_key string, datastream_id long")
    locs = spark.createDataFrame([(3, "ta"), (3, "tb")], "location_id long, thing_key string")
    props = spark.createDataFrame([("u1", "rain"), ("u2", "temp")], "definition string, name string")
    assert navigation.expand(ds, "thing_key", things, "thing_key", "Thing").count() == 2
    left = cleanup.delete_observations_of(obs, ds.filter("datastream_key = 'a'"))
    assert sorted(r.datastream_key for r in left.collect()) == ["b", "b"]
    res = cleanup.cascade_by_property_name(props, ds, obs, things, locs, "rain")
    assert {r.entity: r.n for r in cleanup.plan_counts(res).collect()} == {"Observation": 1, "Datastream": 1, "Thing": 1, "Location": 1}
    assert [r.thing_key for r in res.things.collect()] == ["tb"] and res.observations.count() == 2
    counts = stats.counts_per_datastream(ds, obs, "datastream_key", "datastream_key")
    assert {r.datastream_key: r.n_obs for r in counts.collect()} == {"a": 1, "b": 2}


def test_empty_collections_in_dependency_order():
    class Held:
        def __init__(self):
            self.empty = False

        def clear(self):
            self.empty = True

    tables = {"Things": Held(), "Observations": Held(), "Datastreams": Held()}
    assert cleanup.empty_collections(tables) == ["Observations", "Datastreams", "Things"]
    assert all(t.empty for t in tables.values())


def test_repeated_series_rows_merge_field_by_field(spark):
    from tidewater.plans import loader
    rows = [("C", "S", "B", "Q", "Maximum", None, None, None, 1), ("c", "S", "B", "Q", "", "PT3H", None, None, 2)]
    series = spark.createDataFrame(rows, "COMPARTIMENTO string, ALIAS_STAZIONE string, ALIAS_BACINO string, GRANDEZZA string, "
                                   "INTERPOLATION_TYPE string, AGGREGATION_PERIOD string, INTENDED_TIME_SPACING string, "
                                   "INTENDED_TIME_SPACING_UNIT string, _ord long")
    q = spark.createDataFrame([("Q", "Total", "P1D", "Air")],
                              "GRANDEZZA string, INTERPOLATION_TYPE string, AGGREGATION_PERIOD string, SAMPLE_MEDIUM string")
    e = loader._series_entries(series, q).collect()
    assert len(e) == 1 and (e[0].e_stat, e[0].e_interval) == ("Maximum", 3)


def test_keyed_lookup_and_broadcast_bound(spark):
    from tidewater.operators import joins
    facts = spark.createDataFrame([("a", 1), ("z", 2)], "code string, v long")
    table = spark.sql("SELECT * FROM VALUES ('a', 'Alpha') AS t(k, name)")
    got = sorted((r.code, r.name) for r in joins.lookup(facts, table, {"code": "k"}).collect())
    assert got == [("a", "Alpha"), ("z", None)]          # S2: absent key -> NULL
    plan = joins.bounded_broadcast(table)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()                   # small and measured -> hinted
    unknown = spark.range(10).repartition(2)             # estimate unknown-large
    big = joins.bounded_broadcast(unknown, max_bytes=1)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def test_report_orders(spark):
    t = spark.createDataFrame([("b", 2), ("A", 2), ("c", 5)], "value string, n long")
    assert [r.value for r in stats.tally_order(t).collect()] == ["c", "A", "b"]           # O2
    p = spark.createDataFrame([("beta",), (None,), ("Alpha",)], "name string")
    assert [r.name for r in stats.observed_property_order(p).collect()] == [None, "Alpha", "beta"]   # O3


def test_mask_no_data(spark):
    from tidewater.operators import quality
    df = spark.createDataFrame([(1.5,), (-9999.0,), (None,)], "result double")
    got = [r.result for r in quality.mask_no_data(df).collect()]
    assert got == [1.5, None, None]
    assert quality.mask_no_data(df).agg(F.avg("result")).first()[0] == 1.5
