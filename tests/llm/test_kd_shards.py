"""Operator 10: the law of the leaves, slots, skewed dimensions, edge rows."""

import zlib

from pyspark.sql import functions as F

from tests.llm.conftest import CHECK, EDGES, frame
from tidewater.llm.kd_shards import find_splits, kd_shards, number_slots, place


def check(got, rows, shards, slack):
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    total, largest = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in by.get(s, [])) - total / shards) <= slack * largest + 0.01 * total / shards


def test_whole_table_is_even(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = kd_shards(docs, ["n_chars"], ["source", "lang"], shards=24).collect()
    check(got, rows, 24, 2.0)


def test_one_value_holds_most_rows(spark):
    rows = [(i, "t" * (20 + i % 7), "en", "hot" if i % 4 else f"s{i % 9}") for i in range(3000)]
    got = kd_shards(frame(spark, rows).repartition(5), [], ["source"], shards=7).collect()
    check(got, [r[:2] for r in rows], 7, 2.0)


def test_target_bytes_choose_the_leaves(spark):
    rows = [(i, "t" * 92) for i in range(400)]           # 100 bytes a row
    got = kd_shards(frame(spark, rows), ["n_chars"], [], target_bytes=8_000).collect()
    assert {r.shard for r in got} == set(range(5))
    check(got, rows, 5, 2.0)


def test_edges_and_empty(spark, edges, nothing):
    got = kd_shards(edges, ["n_chars"], ["source"], shards=3).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in EDGES)
    for s in range(3):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    assert kd_shards(nothing, ["n_chars"], ["source"], shards=3).count() == 0
    assert kd_shards(nothing, ["n_chars"], [], target_bytes=100).count() == 0


def test_splits_are_weighted_quantiles(spark):
    rows = sorted((i * i, 1 + i % 5) for i in range(2000))
    points = spark.createDataFrame(rows, "d0 long, weight long")
    keyed = points.withColumn("keys", F.array("d0")).withColumn("node", F.lit(0))
    (dim, at), = find_splits(keyed, {0: 3}, [1]).values()
    total = sum(w for _, w in rows)
    left = sum(w for k, w in rows if k < at)
    assert dim == 0 and abs(left - total / 3) <= 5 + total / 3 / 400
    shards = {}
    for r in place(points, ["d0"], 3).collect():
        shards[r.shard] = shards.get(r.shard, 0) + r.weight
    assert set(shards) == {0, 1, 2} and all(abs(w - total / 3) <= 15 + total / 100 for w in shards.values())


def test_many_leaves(spark):
    rows = [(i, "t" * (20 + i % 11), "en", f"s{i % 9}") for i in range(6000)]
    got = kd_shards(frame(spark, rows), ["n_chars"], ["source"], shards=150).collect()
    check(got, [r[:2] for r in rows], 150, 8.0)


def test_slots_over_several_buckets(spark):
    df = spark.createDataFrame([(i, i % 13, i % 3) for i in range(500)], "doc_id long, text_crc32 long, shard int")
    got = number_slots(df, 8).collect()
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(i % 3 == s for i in range(500))))


def test_rows_without_an_id_spread(spark):
    rows = [(None if i % 3 else i, "t" * 40) for i in range(3000)]
    got = kd_shards(frame(spark, rows).repartition(4), ["n_chars"], ["source"], shards=6).collect()
    check(got, rows, 6, 2.0)
