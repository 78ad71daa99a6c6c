"""Operator 5: file format round trips against the tokenizers library."""

import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm.token_records import END_ID, MARKS, WordEncoder, frame as framed, ids_of, read_records, read_shuffled, unframe, write_records

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [END_ID]


def brute(rows, reference):
    out, start = [], 0
    tie = lambda t: 42 if t is None else int(np.uint64(xxhash.xxh64_intdigest(t, seed=42)).astype(np.int64))
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]), r[1] or "")):
        ids = reference(t)
        out.append((str(i), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def test_frames_detect_damage():
    data = framed(b"payload") + framed(b"")
    first, at = unframe(data, 0)
    assert first == b"payload" and unframe(data, at) == (b"", len(data))
    for i in range(at):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            unframe(bytes(bad), 0)


def test_edges_round_trip(spark, edges, tmp_path, reference):
    rows = EDGES + [(50, "<|endoftext|> is text"), (51, "a\x1cb\x85c İstanbul ΣΑΣ")]
    files = write_records(frame(spark, rows).repartition(5), f"file://{tmp_path}/a", PATH)
    got = sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in read_records(files, f"file://{tmp_path}/a").collect())
    assert got == brute(rows, reference)
    mixed = read_shuffled(spark, files, f"file://{tmp_path}/a", 3).collect()
    assert sorted((str(r.doc_id), r.ids) for r in mixed) == sorted((str(i), reference(t)) for i, t in rows)


def test_empty(spark, nothing, tmp_path):
    files = write_records(nothing, f"file://{tmp_path}/b", PATH)
    assert read_records(files, f"file://{tmp_path}/b").count() == 0


def test_whole_table(spark, tmp_path, reference):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    files = write_records(docs, f"file://{tmp_path}/c", PATH)
    got = sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in read_records(files, f"file://{tmp_path}/c").collect())
    assert got == brute(rows, reference)
    assert ids_of(bytes([2]) + np.array([1, 2], "<u2").tobytes()).tolist() == [1, 2]


def test_letters_and_marks_of_all_scripts(reference):
    rnd, own = random.Random(8), WordEncoder(PATH, END_ID)
    letters = [chr(i) for i in range(32, 0x3100) if chr(i).isalpha() or unicodedata.category(chr(i))[0] in "MPN"]
    special = list("İıßŉǰΐ") + ["\u0958", "\u0959", "\u0a33", "\u0f52", "\u1e9e", "\u0130", "\u0307", "é", "e\u0301"]
    texts = ["Merhaba ALİ, nasılsın", "ख़,", "ਲ਼!", "དྷ.", "a <|endoftext|> b", "x<|startoftext|>,"]
    for _ in range(6000):
        word = "".join(rnd.choice(special if rnd.random() < 0.3 else letters) for _ in range(rnd.randint(1, 4)))
        texts.append(word + rnd.choice(MARKS) + rnd.choice(["", " ", "x"]))
    assert [x.tolist() for x in own.encode(texts)] == [reference(t) for t in texts]


def test_one_id_spreads_over_tasks(spark, tmp_path):
    docs = frame(spark, [(None if i % 3 else i, f"text {i} " * 20) for i in range(600)]).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = write_records(docs, f"file://{tmp_path}/d", PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.count() > 2 and files.agg({"frames": "max"}).first()[0] < 400
    assert read_shuffled(spark, files, f"file://{tmp_path}/d", 1, handles=1).count() == 600
