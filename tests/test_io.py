"""Sources and sinks: zip archives, batch documents and entity folders round
trip, sorted rewrite, incremental stream."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import write_fixture
from tidewater.operators import batches, sorting
from tidewater.plans import entities, mapping
from tidewater.plans.catalog import Catalog
from tidewater.sinks import files as sinks
from tidewater.sources import archives
from tidewater.sources import entities as entity_src
from tidewater.sources.csv_tables import DistrictFolder
from tidewater.sources.driver import OBSERVATION_COLUMNS
from tidewater.streaming import incremental as inc


@pytest.fixture(scope="module")
def cat(spark, tmp_path_factory):
    root = write_fixture(str(tmp_path_factory.mktemp("district_io")))
    return Catalog(DistrictFolder(spark, root))


def test_zip_archives(spark, tmp_path):
    body = "﻿" + ";".join(OBSERVATION_COLUMNS) + "\n" + ";".join(["BA"] + ["x"] * 18) + "\n" + \
        ";".join(["BO"] + ["y"] * 18) + "\n"
    with zipfile.ZipFile(tmp_path / "BARI.zip", "w") as z:
        z.writestr("BARI/OSSERVAZIONI_BA.csv", body)
        z.writestr("BARI/readme.txt", "not csv")
    df = archives.read_zip_csv(spark, str(tmp_path), OBSERVATION_COLUMNS, "osservazioni")
    got = sorted((r.COMPARTIMENTO, r._line) for r in df.collect())
    assert got == [("BA", 0), ("BO", 1)]
    bad = tmp_path / "bad"
    bad.mkdir()
    with zipfile.ZipFile(bad / "EVIL.zip", "w") as z:
        z.writestr("../OSSERVAZIONI_X.csv", body)
    with pytest.raises(Exception) as e:
        archives.read_zip_csv(spark, str(bad), OBSERVATION_COLUMNS).collect()
    assert "escapes" in str(e.value)


def test_batch_documents_round_trip(spark, cat, tmp_path):
    obs = mapping.map_observations(cat)
    b = batches.extent_first(batches.number_batches(obs, "datastream_key", "_ord", 2), "datastream_key",
                             "phenomenon_time")
    b = b.withColumn("iot_id", F.col("obs_id")).withColumn("phenomenonTime", F.col("phenomenon_time"))
    docs = batches.batch_documents(b, "datastream_key", "datastream_id", ["iot_id", "phenomenonTime", "result"])
    out = str(tmp_path / "batches")
    sinks.write_batch_documents(docs, out)
    body = T.StructType([T.StructField("iot_id", T.LongType()), T.StructField("phenomenonTime", T.StringType()),
                         T.StructField("result", T.DoubleType())])
    back = entity_src.read_batch_documents(spark, out, body)
    assert sorted((r.iot_id, r.request_idx) for r in back.collect()) == \
        sorted((r.obs_id, r.request_idx) for r in b.collect())


def test_entity_folders_round_trip(spark, cat, tmp_path):
    frames = {"Things": entities.things(cat), "Locations": entities.locations(cat),
              "Datastreams": entities.datastreams(cat), "Sensors": entities.sensors(cat),
              "ObservedProperties": entities.observed_properties(cat)}
    out = str(tmp_path / "sta")
    sinks.write_entities(frames, out)
    back = entity_src.read_entities(spark, out)
    assert back["Things"].count() == 3 and back["Datastreams"].count() == 2
    one = entity_src.entity_by_id(back["Things"], "thing_id", frames["Things"].first().thing_id)
    assert one.count() == 1


def test_sorted_rewrite(spark, cat, tmp_path):
    raw = cat.source.raw_observations()
    out = str(tmp_path / "sorted")
    sinks.write_sorted(sorting.sorted_observations(raw, 3), out, sep=";")
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    rows = []
    for p in parts:
        with open(os.path.join(out, p), encoding="utf-8") as f:
            rows += [line.rstrip("\n").split(";") for line in f.readlines()[1:]]
    key = [(r[0], r[1], r[2], r[3], int(r[11]) if r[11].strip().isdigit() else 2147483647,
            int(r[12]) if r[12].strip().isdigit() else 2147483647) for r in rows]
    assert key == sorted(key) and len(rows) == raw.count()


def test_incremental_stream_is_idempotent(spark, tmp_path):
    src_dir, sink, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "obs_id long, datastream_key string, phenomenon_time string"
    spark.createDataFrame([(1, "a", "t1"), (2, "a", "t2")], schema).write.parquet(f"{src_dir}/f1")
    stream = lambda: inc.file_stream(spark, f"{src_dir}/*", T.StructType.fromDDL(schema), glob="*.parquet")
    run = lambda c: inc.run_available_now(spark, stream(), lambda b: b, sink, c)
    run(ck)
    assert spark.read.parquet(sink).count() == 2
    run(ck)                                    # nothing new
    assert spark.read.parquet(sink).count() == 2
    spark.createDataFrame([(2, "a", "t2"), (2, "b", "t3")], schema).write.parquet(f"{src_dir}/f2")
    run(ck)                                    # only (b, t3) is new, though its id clashes
    key = lambda: sorted((r.datastream_key, r.phenomenon_time) for r in spark.read.parquet(sink).collect())
    assert key() == [("a", "t1"), ("a", "t2"), ("b", "t3")]
    for f in os.listdir(sink):                 # replays do not depend on marker files
        if f == "_SUCCESS":
            os.remove(os.path.join(sink, f))
    run(str(tmp_path / "fresh"))               # full replay adds nothing
    assert len(key()) == 3


def test_stored_table_replaces_by_key(spark, tmp_path):
    """Keys whose path-safe names are equal stay apart; replacing, deleting and
    adding new rows touch only their own key, also within one bucket."""
    from tidewater.sinks.tables import ObservationTable
    schema = "datastream_key string, phenomenon_time string, v int, arrival int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    for buckets in (1, 16):
        t = ObservationTable(spark, str(tmp_path / f"t{buckets}"), df([]).schema, buckets=buckets)
        rows = lambda: sorted((r.datastream_key, r.phenomenon_time, r.v) for r in t.read().collect())
        assert rows() == []
        t.replace(df([("a/b", "t1", 1, 1)]))
        t.replace(df([("a:b", "t1", 2, 2)]))
        assert rows() == [("a/b", "t1", 1), ("a:b", "t1", 2)]
        t.append_new(df([("a/b", "t1", 9, 3), ("c", "t2", 6, 5), ("c", "t2", 5, 4)]), ["datastream_key", "phenomenon_time"], ["arrival"])
        assert rows() == [("a/b", "t1", 1), ("a:b", "t1", 2), ("c", "t2", 5)]
        assert t.load(df([("c", "t3", 7, 6)])) == 1
        t.delete(spark.createDataFrame([("a/b",), ("c",)], "datastream_key string"))
        assert rows() == [("a:b", "t1", 2)]
        t.clear()
        assert rows() == []


def test_table_folder_as_stream(spark, tmp_path):
    """A table that is a folder of part files streams like one file."""
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    schema = spark.read.parquet(str(tmp_path / "events.parquet")).schema
    got = []
    q = (inc.table_stream(spark, str(tmp_path), "events", schema).writeStream
         .foreachBatch(lambda b, _: got.extend(r.id for r in b.collect()))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(got) == list(range(10))


def test_archive_order_with_many_entries(spark, tmp_path):
    """More than 4,096 entries and several archives keep their order."""
    for a in ("A", "B"):
        with zipfile.ZipFile(tmp_path / f"{a}.zip", "w") as z:
            for i in range(4200):
                z.writestr(f"osservazioni_{i:05d}.csv", f"X;Y\n{a};{i}\n")
    df = archives.read_zip_csv(spark, str(tmp_path), ["X", "Y", "Z"]).orderBy("_ord")
    got = [(r.X, int(r.Y), r.Z) for r in df.select("X", "Y", "Z").collect()]
    assert got == [(a, i, None) for a in ("A", "B") for i in range(4200)]
    assert df.select("_ord").distinct().count() == 8400


def test_large_archives_are_opened_as_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "INLINE", 10)
    with zipfile.ZipFile(tmp_path / "with space.zip", "w") as z:
        z.writestr("osservazioni.csv", 'X,Y\n"a\nb",1\nc,2\n')
    got = [(r.X, r.Y) for r in archives.read_zip_csv(spark, str(tmp_path), ["X", "Y"]).orderBy("_ord").collect()]
    assert got == [("a\nb", "1"), ("c", "2")]


def test_observation_model_partitioned_write(spark, cat, tmp_path):
    """K7 + F19: nested observation documents in a stored table."""
    obs = mapping.observation_model(mapping.map_observations(cat))
    out = str(tmp_path / "obs")
    sinks.write_observations(obs, out)
    back = spark.read.parquet(out)
    assert back.count() == obs.count()
    r = back.filter(F.col("resultQuality.DQ_Status.code") == "XX9").first()
    assert r.resultQuality.DQ_Status.label == "XX9" and r.parameters.editorIndividual == "Bianchi"
    assert sorted({x.datastream_key for x in back.select("datastream_key").collect()}) == [
        "BA-OFANTO-CANOSA-PIOGGIA", "BA-OFANTO-CANOSA-TEMP_MEDIA"]


def test_station_series_keeps_stations_without_series(cat):
    s = {(r.ALIAS_STAZIONE, r.GRANDEZZA) for r in cat.station_series().collect()}
    assert ("SENZA SERIE", None) in s   # D4


def test_legacy_single_observation_files(spark, tmp_path):
    d = tmp_path / "single" / "DS-1"
    d.mkdir(parents=True)
    (d / "obs_1.json").write_text('{"iot_id": 7, "phenomenonTime": "2024-01-01T00:00:00Z", "result": 1.5}')
    (d / "obs_2.json").write_text('{\n "iot_id": 8,\n "phenomenonTime": "2024-01-02T00:00:00Z",\n "result": 2.5\n}')
    body = T.StructType([T.StructField("iot_id", T.LongType()), T.StructField("phenomenonTime", T.StringType()),
                         T.StructField("result", T.DoubleType())])
    got = entity_src.read_observation_files(spark, None, str(tmp_path / "single"), body)
    assert sorted((r.datastream, r.iot_id, r.result) for r in got.collect()) == [("DS-1", 7, 1.5), ("DS-1", 8, 2.5)]


@pytest.mark.parametrize("zipped", [False, True])
def test_district_files_are_streamed(tmp_path, zipped):
    import random
    import zipfile

    from pyarrow import fs
    from tidewater.sinks.districts import put_file
    rng, seen = random.Random(1), []

    def rows():
        for i in range(20_000):
            if i == 19_999:                              # most of the file is out before its last row is asked for
                seen.extend(f.stat().st_size for f in tmp_path.rglob("_*"))
            yield i, f'à "{rng.getrandbits(200)}"\nb;c', None

    path = tmp_path / "Distretto A" / "f"
    assert put_file(fs.LocalFileSystem(), str(path), 1, ["N", "T", "X"], rows(), zipped) == 20_000
    assert len(seen) == 1 and seen[0] > 0.8 * path.stat().st_size
    body = zipfile.ZipFile(path).read("osservazioni.csv") if zipped else path.read_bytes()
    assert body.startswith(b"\xef\xbb\xbfN,T,X\n0,") and [p.name for p in path.parent.iterdir()] == ["f"]


def test_district_file_width_does_not_grow_with_the_table():
    from tidewater.plans.registry import FILE_WIDTH, _file_width
    assert [_file_width(n) for n in (0, 7, 10 ** 9, 10 ** 12)] == [1, 2, FILE_WIDTH, FILE_WIDTH]
