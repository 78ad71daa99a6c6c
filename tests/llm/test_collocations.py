"""Operator 12 and its automata against plain counters."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm import automata, collocations as c
from tidewater.llm.automata import Automaton, cut_points, narrowed, united


def table(counts):
    words = sorted({w for p in counts for w in p})
    number = {w: i for i, w in enumerate(words, 1)}
    rows = sorted([number[w] for w in p] + [0] * (3 - len(p)) for p in counts)
    return words, np.array(rows, np.int64).reshape(-1, 3), np.array([counts[tuple(words[x - 1] for x in r if x)] for r in rows], np.int64)


def counter(t):
    return Counter({tuple(t[0][x - 1] for x in r if x): n for r, n in zip(t[1].tolist(), t[2].tolist())})


def some_counts(rnd, words=(b"a", b"b", b"cc", b"d\x00", b"e")):
    return Counter({tuple(rnd.choice(words) for _ in range(rnd.randint(1, 3))): rnd.randint(1, 300) for _ in range(rnd.randint(0, 40))})


@pytest.mark.parametrize("wide", [1 << 21, 3])
def test_automata(wide, monkeypatch):
    monkeypatch.setattr(automata, "WIDE", wide)
    rnd = random.Random(wide)
    for _ in range(150):
        a, b = some_counts(rnd), some_counts(rnd)
        built = Automaton.from_bytes(Automaton.build(table(a)).to_bytes())
        assert counter(built.table()) == a
        both = united([built.table(), table(b)])
        assert counter(both) == a + b
        asked = sorted(some_counts(rnd, (b"a", b"b", b"cc", b"0", b"zz")))
        assert Automaton.build(both).compose(asked) == [(a + b)[p] for p in asked]
        borders, keys = sorted(some_counts(rnd, (b"a", b"bb", b"cc", b"0", b"zz"))), sorted(a + b)
        assert cut_points(both, borders) == [sum(k < x for k in keys) for x in borders]
        rows = sorted(rnd.sample(range(len(keys)), len(keys) // 2))
        assert counter(narrowed(both, np.array(rows, np.int64))) == {keys[i]: (a + b)[keys[i]] for i in rows}


def test_equal_states_are_one():
    words = [f"w{i:03}".encode() for i in range(200)]
    built = Automaton.build(table(Counter({(w, b"x", b"y"): 5 for w in words})))
    assert len(built.first) - 1 == 4                     # none, last arc, middle arc, root


def brute(rows, min_count, percent, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        scored, holder = [], Counter()                   # largest count of a longer candidate around a pair
        for p, a in own.items():
            if len(p) == 3 and a >= min_count:
                for q in (p[:2], p[1:]):
                    holder[q] = max(holder[q], a)
        for p, a in own.items():
            if len(p) == 1 or a < min_count:
                continue
            if len(p) == 2 and holder[p] and 100 * holder[p] >= percent * a:
                continue
            score, k = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def compared(spark, rows, **how):
    docs = frame(spark, [(i, t, lang) for i, (lang, t) in enumerate(rows)]).repartition(3)
    how = {"min_count": 10, "contained_percent": 50, "top": 2000} | how
    got = c.collocations(docs, **how).collect()
    want = brute(rows, how["min_count"], how["contained_percent"], how["top"])
    assert sorted(map(tuple, got)) == want
    return want


def test_small_shards_and_unions(spark, monkeypatch):
    monkeypatch.setattr(c, "SHARD_WORDS", 300)
    monkeypatch.setattr(c, "UNION_PHRASES", 50)
    monkeypatch.setattr(c, "SAMPLE_ROWS", 5)             # most languages are missed by the sample
    rnd = random.Random(3)
    words = "the of New york City xé Éa b-c".split()
    rows = [(rnd.choice(["en", "fr", None, "und", "de"]), "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", ". ", "\n", " "])
            for _ in range(rnd.randint(0, 60)))) for _ in range(120)]
    assert len(compared(spark, rows, min_count=4)) > 100
    compared(spark, rows, min_count=2, top=7, contained_percent=90)


def test_edges(spark, nothing):
    rows = [(None, t) for _, t in EDGES] * 6 + [("en", None), ("en", "..."), ("en", "same words again and same words again " * 40)]
    assert compared(spark, rows)
    assert c.collocations(nothing).count() == 0


def test_whole_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert compared(spark, rows)
