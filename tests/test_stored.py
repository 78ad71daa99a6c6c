"""Stored tables through changes and stops: generations, folders that change,
entity stores, batch records, replaced folders, damaged files, layouts, totals."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidewater.operators.entity_store import CASCADE, EntityStore
from tidewater.plans.totals import RunTotals
from tidewater.sinks.batch_log import BatchLog
from tidewater.sinks.files import current_folder, finish_replacing, replace_folder
from tidewater.sinks.generations import GenerationStore
from tidewater.sinks.tables import ObservationTable
from tidewater.sources.archives import read_whole_archives, read_zip_csv
from tidewater.sources.csv_tables import read_text_table
from tidewater.sources.hadoop import Folders, list_files
from tidewater.streaming.file_ledger import FILE, FolderLoad, stale_sources


# ------------------------------------------------------------- generations
def test_a_change_is_seen_whole_or_not_at_all(spark, tmp_path):
    store = GenerationStore(spark, f"{tmp_path}/a b")
    one, two = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    first = store.commit({"t": one, "u": one})
    assert first.number == 1 and store.snapshot() == first
    second = store.commit({"t": two}, note={"k": 1})
    assert (store.read("t").count(), store.read("u").count(), store.read("t", first).count()) == (5, 3, 3)
    assert second.note == {"k": 1} and store.commit({}).note == {"k": 1}
    with pytest.raises(FileExistsError):                 # started from a generation that has a successor
        store.commit({"t": one}, base=second)
    assert len(store.recover()) == 1 and store.recover() == []
    assert store.read("t").count() == 5
    empty = store.commit({"t": two.limit(0)})
    assert store.read("t", empty).dtypes == two.dtypes and store.read("t").count() == 0


def test_a_stop_before_publishing_leaves_nothing(spark, tmp_path, monkeypatch):
    store = GenerationStore(spark, f"{tmp_path}/s")
    store.commit({"t": spark.range(1).toDF("x")})

    def stop(new):
        raise InterruptedError

    monkeypatch.setattr(store, "_publish", stop)
    with pytest.raises(InterruptedError):
        store.commit({"t": spark.range(9).toDF("x")})
    again = GenerationStore(spark, f"{tmp_path}/s")
    assert again.snapshot().number == 1 and again.read("t").count() == 1
    assert len(again.recover()) == 1 and again.read("t").count() == 1


# ------------------------------------------------- folders that change
SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()), T.StructField("line", T.LongType())])


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("key;value\n" + "".join(f"{x}\n" for x in lines))


def folder_load(spark, tmp_path, name, reads):
    folder = f"{tmp_path}/in"

    def load_files(paths):
        reads.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        df = read_text_table(spark, paths, with_order=True)
        return df.select("key", "value", F.col("_ord.row").alias("line"), F.regexp_extract("_ord.file", r"/in/(.*)$", 1).alias(FILE))

    return FolderLoad(spark, f"{tmp_path}/{name}", folder, SCHEMA, load_files, ["key"], ["line"], "*.csv")


def state(load):
    return rows(load.read(), "key", "value")


def test_changed_files_give_the_table_of_a_full_load(spark, tmp_path):
    folder, reads = f"{tmp_path}/in", []
    load = folder_load(spark, tmp_path, "t", reads)
    assert rows(load.run()) == [] and state(load) == []
    put(folder, "a.csv", ["1;a", "2;a", "2;again"])
    put(folder, "b.csv", ["2;b", "3;b"])
    put(folder, "c.csv", ["4;c"])
    assert rows(load.run()) == [("new", 3)] and reads.pop() == ["a.csv", "b.csv", "c.csv"]
    assert state(load) == [("1", "a"), ("2", "a"), ("3", "b"), ("4", "c")]
    assert rows(load.run()) == [("unchanged", 3)] and reads == []
    put(folder, "a.csv", ["1;changed"])                  # changed: key 2 now comes from b
    os.remove(f"{folder}/c.csv")                         # vanished
    put(folder, "d.csv", ["5;d"])                        # new
    Folders(spark).touch(f"{folder}/b.csv", 1_600_000_000_000)
    put(folder, "e.csv", [])
    assert rows(load.run()) == [("changed", 2), ("new", 2), ("vanished", 1)] and reads.pop() == ["a.csv", "b.csv", "d.csv", "e.csv"]
    full = folder_load(spark, tmp_path, "full", [])
    full.run()
    assert state(load) == state(full) == [("1", "changed"), ("2", "b"), ("3", "b"), ("5", "d")]
    stored = load._stored().count()
    load.compact()
    assert state(load) == state(full) and load._stored().count() == 4 < stored
    assert rows(load.run()) == [("unchanged", 4)]
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    assert rows(load.run()) == [("vanished", 4)] and state(load) == []


def test_a_stopped_load_adds_nothing(spark, tmp_path, monkeypatch):
    load = folder_load(spark, tmp_path, "t", [])
    put(f"{tmp_path}/in", "a.csv", ["1;a"])
    load.run()
    put(f"{tmp_path}/in", "b.csv", ["2;b"])
    commit = load.store.commit
    monkeypatch.setattr(load.store, "commit", lambda *a, **k: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        load.run()
    assert state(load) == [("1", "a")]
    monkeypatch.setattr(load.store, "commit", commit)
    load.run()
    assert state(load) == [("1", "a"), ("2", "b")]


def test_sources_against_their_targets(spark, tmp_path):
    for side in ("s", "t"):
        for name in ("fresh.csv", "stale.csv", "same.csv") + (("only.csv",) if side == "s" else ("left.csv",)):
            put(f"{tmp_path}/{side}/sub dir", name, ["1;a"])
            Folders(spark).touch(f"{tmp_path}/{side}/sub dir/{name}",
                                 1_700_000_000_000 + (side == "t") * {"fresh.csv": 5000, "stale.csv": -5000}.get(name, 0))
    got = stale_sources(list_files(spark, f"{tmp_path}/s"), list_files(spark, f"{tmp_path}/t"))
    assert rows(got, "name", "reason") == [("sub dir/only.csv", "no target"), ("sub dir/stale.csv", "newer than target")]
    assert stale_sources(list_files(spark, f"{tmp_path}/s"), list_files(spark, f"{tmp_path}/none")).count() == 4


# ------------------------------------------------------------ entity store
def filled(spark, root):
    store = EntityStore(GenerationStore(spark, root))
    frame = lambda data, ddl: spark.createDataFrame(data, ddl)
    store.store.commit({
        "ObservedProperties": frame([("p", "rain"), ("q", "level")], "definition string, name string"),
        "Datastreams": frame([("a1", "a", "p"), ("a2", "a", "q"), ("b1", "b", "p"), ("c1", "c", "q")],
                             "datastream_key string, thing_key string, definition string"),
        "Things": frame([("a", "A"), ("b", "B"), ("c", "C"), ("bare", "D")], "thing_key string, name string"),
        "Locations": frame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("bare", 4.0)], "thing_key string, lon double"),
        "Observations": frame([(k, str(i)) for k in ("a1", "a2", "b1", "c1") for i in range(3)], "datastream_key string, phenomenon_time string")})
    return store


@pytest.mark.parametrize("steps", range(5))
def test_a_cascade_goes_on_where_it_stopped(spark, tmp_path, steps):
    store = filled(spark, f"{tmp_path}/s")
    store.plan_cascade("rain")
    store.resume(steps)
    stopped = store.store.snapshot()
    assert stopped.note.get("to_do", []) == CASCADE[steps:]
    other = EntityStore(GenerationStore(spark, f"{tmp_path}/s"))
    assert other.resume() == CASCADE[steps:] and other.resume() == []
    assert rows(other.read("Datastreams"), "datastream_key") == [("a2",), ("c1",)]
    assert {r[0] for r in rows(other.read("Observations"), "datastream_key")} == {"a2", "c1"}
    assert rows(other.read("Things"), "thing_key") == rows(other.read("Locations"), "thing_key") == [("a",), ("bare",), ("c",)]
    assert other.read("Observations").count() == 6 and store.read("Observations", stopped).count() == (12 if steps == 0 else 6)
    assert other.cascade("no such property") == CASCADE and other.read("Things").count() == 3


def test_observations_beside_the_store(spark, tmp_path, monkeypatch):
    """Only folders of doomed datastreams are rewritten; a stop between the delete
    and the note repeats the delete."""
    store = filled(spark, f"{tmp_path}/s")
    obs = store.read("Observations")
    table = ObservationTable(spark, f"{tmp_path}/o", obs.schema, buckets=64)
    table.append(obs)
    store.observations = table
    files = lambda: {r.path: r.modified for r in list_files(spark, f"{tmp_path}/o", "*.parquet").collect()}
    before = files()
    store.plan_cascade("rain")
    commit = store.store.commit
    monkeypatch.setattr(store.store, "commit", lambda *a, **k: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        store.resume()
    monkeypatch.setattr(store.store, "commit", commit)
    assert store.resume() == CASCADE
    assert {r[0] for r in rows(store.read("Observations"), "datastream_key")} == {"a2", "c1"} and store.read("Observations").count() == 6
    assert set(files().items()) & set(before.items())
    assert store.clear()[0] == "Observations" and store.read("Observations").count() == 0


def test_collections_are_emptied_in_order(spark, tmp_path):
    store = filled(spark, f"{tmp_path}/s")
    store.plan_clear()
    assert store.resume(1) == ["Observations"]
    assert store.clear()[:2] == ["Datastreams", "ObservedProperties"]
    assert all(store.read(k).count() == 0 for k in store.store.snapshot().tables if k != "DeletePlan")


def test_get_or_create_refresh_and_patch(spark, tmp_path):
    store = EntityStore(GenerationStore(spark, f"{tmp_path}/s"))
    sensors = lambda *k: {"Sensors": spark.createDataFrame([(x,) for x in k], "sensor_key string")}
    assert store.ensure(sensors("a", "b", "a"))["Sensors"].count() == 2
    assert store.ensure(sensors("b", "c"))["Sensors"].count() == 1
    at = store.store.snapshot().number
    assert store.ensure(sensors("a", "c"))["Sensors"].count() == 0 and store.store.snapshot().number == at
    assert rows(store.read("Sensors")) == [("a", 1), ("b", 1), ("c", 2)]
    things = lambda *r: {"Things": spark.createDataFrame(r, "thing_key string, name string, note string")}
    store.refresh(things(("a", "A", "x"), ("b", "B", None)))
    store.refresh(things(("a", None, "y"), ("c", "C", None)))
    assert rows(store.read("Things"), "thing_key", "name", "note") == sorted([("a", "A", "y"), ("b", "B", None), ("c", "C", None)], key=str)
    store.patch("Things", "thing_key", "b", {"name": F.lit("new")})
    store.remove("Things", "thing_key", "c")
    assert rows(store.read("Things"), "thing_key", "name") == [("a", "A"), ("b", "new")]


# ----------------------------------------------------------- batch records
BATCHES = T.StructType([T.StructField("datastream_key", T.StringType()), T.StructField("batch_no", T.LongType()), T.StructField("x", T.LongType())])


def test_lost_and_doubled_batches_are_named(spark, tmp_path):
    log = BatchLog(spark, f"{tmp_path}/b", BATCHES)
    frame = lambda *r: spark.createDataFrame([(k, n, i) for k, n, m in r for i in range(m)], BATCHES)
    assert log.read().count() == 0 and log.verify().count() == 0
    first = log.load(frame(("a", 1, 4), ("b", 1, 2)))
    second = log.load(frame(("a", 1, 4), ("a", 2, 3)))                  # batch 1 is tried again
    assert rows(second, "datastream_key", "batch_no", "inserted") == [("a", 2, 3)] and log.read().count() == 9
    assert {r.status for r in log.verify().collect()} == {"ok"}
    folder = f"{tmp_path}/b/rows/load={second.first()['load']}"
    for name in os.listdir(folder):
        if name.startswith("part"):
            os.remove(f"{folder}/{name}")
    frame(("b", 1, 2)).write.mode("append").parquet(f"{tmp_path}/b/rows/load={first.first()['load']}")
    bad = {(r.datastream_key, r.batch_no): r for r in log.verify().filter("status <> 'ok'").collect()}
    assert (bad["a", 2].status, bad["a", 2].inserted, bad["a", 2].expected) == ("lost", 0, 3) and bad["a", 2].missing_files
    assert (bad["b", 1].status, bad["b", 1].inserted, bad["b", 1].expected) == ("doubled", 4, 2) and bad["b", 1].unknown_files
    assert set(bad) == {("a", 2), ("b", 1)}


def test_a_short_batch_is_an_error_and_stays_invisible(spark, tmp_path, monkeypatch):
    log = BatchLog(spark, f"{tmp_path}/b", BATCHES)
    counted = log._counted
    monkeypatch.setattr(log, "_counted", lambda stored: counted(stored.filter("x > 0")))
    data = spark.createDataFrame([("a", 1, 0), ("a", 1, 1)], BATCHES)
    with pytest.raises(AssertionError, match="a batch 1: inserted 1, expected 2"):
        log.load(data)
    assert log.read().count() == 0
    monkeypatch.setattr(log, "_counted", counted)
    log.load(data)
    assert log.read().count() == 2


# -------------------------------------------------------- replaced folders
@pytest.mark.parametrize("stop", ["written", "intent", "moved", "placed", None])
def test_readers_see_old_or_new_files(spark, tmp_path, stop):
    target = f"{tmp_path}/data"
    spark.range(3).write.parquet(target)
    read = lambda: spark.read.parquet(current_folder(spark, target)).count()
    replace_folder(spark, target, lambda out: spark.read.parquet(target).union(spark.range(4)).write.parquet(out), stop)
    assert read() == (3 if stop in ("written", "intent") else 7)
    assert finish_replacing(spark, target) == (stop in ("intent", "moved", "placed"))
    assert read() == (3 if stop == "written" else 7)
    replace_folder(spark, target, lambda out: spark.range(1).write.parquet(out))
    assert read() == 1 and sorted(os.listdir(tmp_path)) == ["data"]


# ----------------------------------------------------------- damaged files
def test_damaged_files_are_left_out_with_a_reason(spark, tmp_path):
    put(tmp_path, "good one.csv", ["1;a", "2;é"])
    put(tmp_path, "short.csv", [])
    with open(f"{tmp_path}/bytes.csv", "wb") as f:
        f.write(b"key;value\n1;\xe9\n")
    with open(f"{tmp_path}/other.csv", "w") as f:
        f.write("key;other\n1;a\n")
    open(f"{tmp_path}/empty.csv", "w").close()
    paths, bad = [f"file:{tmp_path}/{n}.csv" for n in ("good one", "short", "bytes", "other", "empty")], []
    got = read_text_table(spark, paths, ["key", "value"], rejects=bad)
    assert rows(got) == [("1", "a"), ("2", "é")]
    assert {p.rsplit("/", 1)[-1]: r for p, r in bad} == {"bytes.csv": "not UTF-8", "other.csv": "lacks columns value", "empty.csv": "empty file"}
    assert read_text_table(spark, [paths[4]]) is None


def test_damaged_archives_are_left_out_with_a_reason(spark, tmp_path):
    def archive(name, body):
        with zipfile.ZipFile(f"{tmp_path}/{name}", "w", zipfile.ZIP_STORED) as z:
            z.writestr("x.csv", body)

    archive("good.zip", b"key;value\n1;a\n")
    archive("bytes.zip", b"key;value\n1;a\n2;\xff\n")
    archive("sum.zip", b"key;value\n" + b"1;abc\n" * 9000)
    archive("cut.zip", b"key;value\n1;a\n")
    data = bytearray(open(f"{tmp_path}/sum.zip", "rb").read())
    data[40_000] ^= 1
    open(f"{tmp_path}/sum.zip", "wb").write(data)
    data = open(f"{tmp_path}/cut.zip", "rb").read()
    open(f"{tmp_path}/cut.zip", "wb").write(data[:len(data) // 2])
    good, bad = read_whole_archives(spark, str(tmp_path), ["key", "value"])
    assert rows(good, "key", "value") == [("1", "a")]
    reasons = {r.archive.rsplit("/", 1)[-1]: r.reason.split(":")[0] for r in bad.collect()}
    assert reasons == {"bytes.zip": "UnicodeDecodeError", "sum.zip": "BadZipFile", "cut.zip": "BadZipFile"}
    with pytest.raises(Exception, match="BadZipFile|zip file"):
        read_zip_csv(spark, str(tmp_path), ["key", "value"]).count()


# ------------------------------------------------------------------ layout
def test_a_hot_datastream_is_written_by_many_tasks(spark, tmp_path):
    hot = spark.range(60_000).select(F.lit("hot").alias("datastream_key"), F.concat(F.lit("2024-01-01T"), F.col("id").cast("string")).alias("phenomenon_time"),
                                     F.rand(1).alias("result"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("note"))
    table = ObservationTable(spark, f"{tmp_path}/t", hot.schema, buckets=4)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        table.append(hot.repartition(8))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert list_files(spark, f"{tmp_path}/t", "*.parquet").count() > 4 and table.read().count() == 60_000
    assert table.compact(2) == 1 and table.read().count() == 60_000 and table.compact(2) == 0


def test_a_micro_batch_meets_only_its_own_years(spark, tmp_path):
    frame = lambda *r: spark.createDataFrame(r, "datastream_key string, phenomenon_time string, result double")
    table = ObservationTable(spark, f"{tmp_path}/t", frame(("a", "x", 1.0)).schema, buckets=4)
    key = ["datastream_key", "phenomenon_time"]
    table.append_new(frame(*[("a", f"{y}-01-01T00:00:00Z", 1.0) for y in range(1990, 2000)], ("a", None, 2.0), ("b", "bad", 2.0)), key)
    table.append_new(frame(("a", "1995-01-01T00:00:00Z", 9.0), ("a", "1995-02-01T00:00:00Z", 9.0), ("b", "bad", 9.0)), key)
    got = [tuple(r) for r in table.read().collect()]
    assert len(got) == 13 and sum(r[2] == 9.0 for r in got) == 1
    held = table.held_for(table._placed(frame(("a", "1995-03-01T00:00:00Z", 0.0))))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "period" in plan.split("PartitionFilters")[1].split("]")[0] and held.count() == 2
    table.delete(frame(("a", None, None)))
    assert rows(table.read()) == [("b", "bad", 2.0)]


# ------------------------------------------------------------------ totals
def test_totals_ride_on_the_write(spark, tmp_path):
    totals = RunTotals()
    df = totals.watch(spark.range(1000).repartition(7), n=F.count(F.lit(1)), odd=F.count(F.when(F.col("id") % 2 == 1, 1)))
    df.write.parquet(f"{tmp_path}/o")
    assert totals.values() == {"n": 1000, "odd": 500}
    assert rows(totals.frame(spark)) == [("n", 1000), ("odd", 500)]
