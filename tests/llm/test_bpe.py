"""Operator 8 against the tiktoken library; long texts are cut into tiny chunks."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm.bpe import CHUNK, OVERLAP, decode, encode, load_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SPACES = ["a  b", "a   b", " a\n b  \nc  ", "a \n", "it's  'tis x'll'", "don't-stop!!  99 bottles", "\x1c \x1c",
          " ", "  ", "tab\t \tx", "ümläut   ß", "“quotes” … —"]


@pytest.fixture(scope="module")
def reference():
    own = tiktoken.Encoding("ref", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})
    return lambda t: own.encode_ordinary(t or "")


def check(df, rows, reference, **how):
    got = encode(df, RANKS, public_tokenizers.PATTERN, with_parts=True, **how).collect()
    want = sorted((str(i), ",".join(map(str, reference(t))), len(reference(t)), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.n_tokens, bytes(r.decoded)) for r in got) == want


def test_edges_whole_and_chunked(spark, edges, nothing, reference):
    rows = EDGES + [(100 + i, s) for i, s in enumerate(SPACES)]
    check(frame(spark, rows), rows, reference)
    small = [(i, t) for i, t in rows if len(t or "") < 6000]
    check(frame(spark, small), small, reference, chunk=16, overlap=12)
    check(frame(spark, small), small, reference, chunk=40, overlap=3)      # hardly ever resynchronises
    assert encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_stitched(spark, reference):
    text = " ".join(f"wörd{i} don't  stop\n\n{i}!" for i in range(900))
    rows = [(1, text), (2, text[3:]), (2, text[3:]), (None, "y" * 3000 + text)]
    check(frame(spark, rows), rows, reference, chunk=500, overlap=60)


def test_digests_and_decode(spark, reference):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = encode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference(texts[r.doc_id])
        joined = ",".join(map(str, ids))
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(joined.encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert decode(joined, RANKS, public_tokenizers.PATTERN) == texts[r.doc_id].encode() and decode("", RANKS, public_tokenizers.PATTERN) == b""


BLANKS = " \t\n\r\x0b\x0c\x1c\x85\u00a0\u2003\u3000"


@pytest.mark.parametrize("ranks", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_blanks_at_chunk_borders(spark, ranks):
    path, rnd = public_tokenizers.path(ranks), random.Random(4)
    own = tiktoken.Encoding("ref", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    some = lambda: "".join(rnd.choice([rnd.choice(BLANKS) * rnd.randint(1, 3), rnd.choice(["ab", "Wö", "7", "'s", "!?", "x"])])
                           for _ in range(rnd.randint(1, 60)))
    texts = [some() for _ in range(2500)]
    for n in range(CHUNK - 3, CHUNK + 3):                # every place of the blanks about the border of a real chunk
        for gap in (" \u00a0", "\n\n", " \t ", "\u00a0 ", "   "):
            texts.append(("word " * (n // 5 + 1))[:n] + gap + "word " * 400)
    for chunk, overlap, chosen in ((20, 10, texts[:2500]), (CHUNK, OVERLAP, texts[2500:])):
        docs = frame(spark, list(enumerate(chosen))).repartition(4)
        got = {r.doc_id: r for r in encode(docs, path, public_tokenizers.PATTERN, with_parts=True, chunk=chunk, overlap=overlap).collect()}
        for i, t in enumerate(chosen):
            assert got[i].ids == ",".join(map(str, own.encode_ordinary(t))), (chunk, t[-80:])
            assert bytes(got[i].decoded) == t.encode()
