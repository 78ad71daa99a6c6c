"""Operator 2 against a plain grouping; heavy and ordinary digests both occur."""

import hashlib
import re

import pyarrow as pa

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm.exact_dedup import drop_exact_copies, exact_groups, summarise


def sha(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t), []).append(i)
    first = {d: min((x for x in g if x is not None), default=None) for d, g in groups.items()}
    return sorted((str(i), str(first[sha(t)]), len(groups[sha(t)]), sha(t)) for i, t in rows)


def test_edges_and_forced_heavy_split(spark, edges):
    for share, counters in ((1 / 1000, 4096), (0.1, 16)):
        got = exact_groups(edges, share=share, counters=counters).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute(EDGES)
        kept = [r for r in got if r.kept]
        assert len(kept) == len({sha(t) for _, t in EDGES}) and all(r.doc_id == r.keep_id for r in kept)
        left = drop_exact_copies(edges, share=share, counters=counters)
        assert left.columns == edges.columns
        assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in kept)


def test_hot_digest_takes_the_broadcast_path(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(900)]
    got = exact_groups(frame(spark, rows).repartition(7), share=0.05, counters=64).collect()
    assert {r.text_sha256 for r in got if r.frequent} == {sha("same text")}
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute(rows)


def test_counters_bound():
    """Counters are at most the true count and at least it minus n/(k + 1)."""
    values = [f"v{i * i % 61}" for i in range(3000)] + ["hot"] * 500
    batches = [pa.RecordBatch.from_pydict({"digest": values[i:i + 100]}) for i in range(0, len(values), 100)]
    held = dict(zip(*next(summarise(9)(iter(batches))).to_pydict().values()))
    assert len(held) <= 9
    for v in set(values):
        true = values.count(v)
        assert true - len(values) / 10 <= held.get(v, 0) <= true


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exact_groups(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute(rows)


def test_empty(spark, nothing):
    assert exact_groups(nothing).count() == 0 and drop_exact_copies(nothing).count() == 0
