"""Operator 13 against a search over all windows."""

import random

import pytest

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm import passages as p


def brute(rows, window):
    """(id, words, removed words, kept text) per row; a null id comes first."""
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    place = lambda i, s: (i is not None, i or 0, s)
    first = {}
    for i, w in docs:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, place(i, s)), place(i, s))
    out = []
    for i, w in docs:
        off = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < place(i, s):
                off.update(range(s, s + window))
        out.append((str(i), len(w), len(off), b" ".join(x for k, x in enumerate(w) if k not in off).decode()))
    return sorted(out)


def check(spark, rows, window=20, parts=4):
    got = p.drop_repeated_passages(frame(spark, rows).repartition(parts), window=window).collect()
    want = brute(rows, window)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == want
    for r in got:
        assert sum(x.last - x.first + 1 for x in r.removed) == r.n_removed
        assert all(a.last + 1 < b.first for a, b in zip(r.removed, r.removed[1:]))
    return sum(w[2] for w in want)


def some_rows(rnd, n, words):
    passages = [[rnd.choice(words) for _ in range(rnd.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rnd.randint(0, 6)):
            text += rnd.choice(passages)[rnd.randint(0, 4):] if rnd.random() < 0.5 else [rnd.choice(words) for _ in range(rnd.randint(0, 30))]
        rows.append((rnd.choice([i, i, i, None, 7]), rnd.choice([" ", "\t ", "\n"]).join(text)))
    return rows + rows[:5]


@pytest.mark.parametrize("wide", [False, True])
def test_shared_passages(spark, monkeypatch, wide):
    if wide:                                             # every name too large for an automaton, down to single windows
        monkeypatch.setattr(p, "NAME_WORDS", 30)
        monkeypatch.setattr(p, "PIECE_WINDOWS", 7)
        monkeypatch.setattr(p, "BITS", 1 << 6)           # the bitmap marks everything
    monkeypatch.setattr(p, "SHARD_WORDS", 400)
    rnd = random.Random(wide)
    assert check(spark, some_rows(rnd, 60, [f"w{i}" for i in range(200)])) > 500
    assert check(spark, some_rows(rnd, 40, ["a", "b"])) > 500
    assert check(spark, some_rows(rnd, 40, ["a", "b", "c"]), window=9) > 500


def test_lines_around_everything(spark, monkeypatch):
    line = " ".join(f"common{i}" for i in range(18))
    rnd = random.Random(2)
    rows = [(i, " ".join(f"u{rnd.random()}" for _ in range(15)) + " " + line + " x " + line + f" {i % 3} {i % 5}") for i in range(80)]
    assert check(spark, rows) > 500
    monkeypatch.setattr(p, "NAME_WORDS", 500)            # only the names of the line
    assert check(spark, rows) > 500


def test_edges(spark, nothing):
    rows = [r for r in EDGES] + [(70, "a " * 700), (71, "b " + "a " * 45), (72, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(40))))]
    assert check(spark, rows) > 500
    assert p.drop_repeated_passages(nothing).count() == 0


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert check(spark, rows) > 500


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    rnd = random.Random(6)
    words = ["a", "b", "ab", "ba", "é", "\x1c", "\x85", "x" * 300, "word", "a\x00b"] + [f"w{i}" for i in range(300)]
    for block in (16, 1 << 20):
        monkeypatch.setattr(p, "BLOCK", block)
        seen = {}
        for _ in range(60):
            text = "".join(rnd.choice(words) + rnd.choice(" \t\n\x0b\x0c\r") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60)))
            raw = (rnd.choice(["", " ", "\n"]) + text.rstrip(rnd.choice([" ", ""]))).encode()
            starts, stops, hashes = p.word_places(raw)
            assert [raw[a:b] for a, b in zip(starts, stops)] == raw.split()
            for w, h in zip(raw.split(), hashes.tolist()):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)
