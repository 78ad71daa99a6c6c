"""The registered frames of this package, as the driver calls them, against their
contracts: columns, folds, digests and laws. Operators have tests of their own."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL
from tests.llm.test_licenses import brute as places
from tests.llm.test_simhash import brute_groups
from tidewater.llm.bpe import load_ranks
from tidewater.llm.queries import QUERIES, SHARDS


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def run(spark, name, *columns):
    df = QUERIES[name](spark, SMALL)
    assert df.columns[:len(columns)] == list(columns) or set(columns) <= set(df.columns)
    return df.collect()


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("name, fold, level", [("op3_toxicity", 3, 0.7), ("op9_quality", 3, 0.5)])
def test_scores(spark, texts, name, fold, level):
    got = run(spark, name, "doc_id", "held_out", "score", "predicted")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (crc(r.doc_id) % fold == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= level)


def test_languages(spark, texts):
    got = run(spark, "op4_language", "doc_id", "held_out", "lang_pred", "score")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id]))


def test_token_records(spark, texts):
    own, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = sorted(run(spark, "op5_token_records", "doc_id", "start", "n_tokens", "ids_crc32"))
    assert [r.doc_id for r in got] == sorted(texts)
    for r in got:
        ids = own.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_fingerprints(spark, texts):
    got = run(spark, "op6_simhash", "doc_id", "fingerprint", "component_id")
    assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower() for r in got)
    assert sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in got) == brute_groups(sorted(texts.items()))


def test_licences(spark, texts):
    for r in run(spark, "op7_licenses", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == places(texts[r.doc_id])
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_byte_ids(spark, texts):
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("ref", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in run(spark, "op8_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"):
        ids, raw = own.encode_ordinary(texts[r.doc_id]), texts[r.doc_id].encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()


def test_shards(spark, texts):
    got = run(spark, "op10_kd_shards", "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    weight, largest = [0] * SHARDS, max(len(t.encode()) + 8 for t in texts.values())
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        weight[r.shard] += r.size
    assert max(abs(w - sum(weight) / SHARDS) for w in weight) <= 2 * largest
    for s in range(SHARDS):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_contaminated_documents_are_named_once(spark, texts):
    got = run(spark, "op1_decontaminate", "doc_id", "item_ids")
    assert got and len({r.doc_id for r in got}) == len(got) and all(r.item_ids == sorted(set(r.item_ids)) for r in got)
