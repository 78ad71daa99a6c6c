"""Operator 11 against a brute-force search over all lags, and against its SQL."""

import random
import time

import numpy as np
import pytest

from tests.llm.conftest import EDGES, frame
from tidewater.llm.runs import collapse, find_runs, periodic_runs, planted_order


def brute(words, min_length=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - s >= max(min_length - q, q):
                found.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rnd, n):
    k, out = rnd.choice([1, 2, 2, 3, 5]), []
    while len(out) < n:
        unit = [rnd.randrange(k) for _ in range(rnd.randint(1, rnd.choice([3, 8, 40])))]
        kind = rnd.random()
        if kind < 0.6 or not out:
            out += unit * rnd.randint(1, 9)
        elif kind < 0.8:
            at = rnd.randrange(len(out))
            out += out[at:at + rnd.randint(1, 60)]
        else:
            out += out[::-1][:rnd.randint(1, 30)]
    return out[:n]


@pytest.mark.parametrize("min_length", [12, 6, 20])
def test_all_runs_are_found(min_length):
    rnd = random.Random(min_length)
    for _ in range(400):
        docs, bounds, at = [some_words(rnd, rnd.randint(0, rnd.choice([30, 120, 250]))) for _ in range(3)], [], 0
        for d in docs:
            bounds.append((at, at + len(d)))
            at += len(d)
        found = find_runs(np.array(sum(docs, []), np.int64), bounds, min_length)
        assert found == [brute(d, min_length) for d in docs]


def test_highly_periodic_texts_take_no_quadratic_time():
    began = time.time()
    for n, q in ((400_000, 1), (400_000, 7), (400_000, 1000)):
        assert find_runs(np.arange(n) % q, [(0, n)]) == [[(0, n, q)]]
    assert time.time() - began < 60


def test_edges(spark, nothing):
    rows = EDGES + [(60, "a b " * 9 + "a"), (61, "x y " * 12), (62, "\x1c \x1c\t" * 7), (63, "la\x0bla\x0cla la " * 4)]
    got = periodic_runs(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = brute(words) if len(words) < 2000 else find_runs(np.array([hash(w) for w in words]).view(np.uint64), [(0, len(words))])[0]
        want.append((str(i), len(words), runs, b" ".join(collapse(words, runs)).decode()))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic_runs(nothing).count() == 0


def test_planted_order():
    assert planted_order(None, 5) is None and planted_order(1, 0) is None
    hit = [i for i in range(200) if planted_order(i, 40) is not None]
    assert 5 < len(hit) < 50
    order = planted_order(hit[0], 40).tolist()
    assert len(order) == 40 and sorted(set(order)) == list(range(len(set(order))))
