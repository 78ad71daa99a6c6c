"""The pipeline against its parts done plainly, stage by stage."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.conftest import SMALL, frame
from tests.llm.test_exact_dedup import sha
from tests.llm.test_simhash import brute_groups
from tidewater.llm import language
from tidewater.llm.bpe import load_ranks
from tidewater.llm.decontaminate import overlaps
from tidewater.llm.queries import BYTE_RANKS, QUERIES


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_columns_and_order(spark, stages):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    assert all(s.columns == docs.columns for s in stages[:-1])


def test_each_stage_is_its_plain_form(spark, stages):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    model = language.train_language_model(spark.read.parquet(f"{SMALL}/documents.parquet"))
    mass, n = language.label_mass([r.text for r in docs], model)
    want = {r.doc_id: r.text for r, m, k in zip(docs, mass.max(1), n) if k and m >= 0.3 * k}
    kept = [{r.doc_id: r.text for r in s.collect()} for s in stages[:-1]]
    assert kept[0] == want
    first = {}
    for i in sorted(want):
        first.setdefault(sha(want[i]), i)
    want = {i: want[i] for i in first.values()}
    assert kept[1] == want
    want = {int(i): want[int(i)] for i, _, c in brute_groups(list(want.items())) if i == c}
    assert kept[2] == want
    bad = {r.doc_id for r in overlaps(frame(spark, want.items()), spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    want = {i: t for i, t in want.items() if i not in bad}
    assert bad and kept[3] == want
    own = tiktoken.Encoding("ref", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_ranks(public_tokenizers.path(BYTE_RANKS)))
    ids = {i: ",".join(map(str, own.encode_ordinary(t))) for i, t in want.items()}
    assert {r.doc_id: r.ids_sha256 for r in stages[4].collect()} == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in ids.items()}


def test_run_and_registration(spark, stages):
    got = QUERIES["pipeline"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_empty_tables(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0, name
