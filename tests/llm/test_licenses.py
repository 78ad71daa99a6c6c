"""Operator 7: matching statistics and phrase places against plain search."""

import random
import re

import numpy as np

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm.licenses import MIN_STRETCH, PHRASES, TEMPLATES, Automaton, best_spans, chain, scan, scan_licenses, words_of


def test_automaton_against_plain_search():
    rng = random.Random(5)
    for _ in range(30):
        templates = [[rng.choice("abcd") for _ in range(rng.randrange(1, 25))] for _ in range(4)]
        phrases = [["a", "b"], ["b", "c", "a"]]
        auto = Automaton(templates, phrases)
        text = [rng.choice("abcdz") for _ in range(200)]
        places, stretches = scan(auto, np.array([auto.vocab.get(w, 0) for w in text]))
        assert sorted(places) == sorted((p, i) for p, ph in enumerate(phrases) for i in range(len(text))
                                        if text[i:i + len(ph)] == ph)
        grams = {tuple(t[i:j]) for t in [*templates, *phrases] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        best = [max((n for n in range(1, e + 2) if tuple(text[e + 1 - n:e + 1]) in grams), default=0) for e in range(len(text))]
        maximal = [(e + 1 - n, n) for e, n in enumerate(best) if n >= MIN_STRETCH and (e + 1 == len(text) or best[e + 1] <= n)]
        assert [s[:2] for s in stretches] == maximal
        for start, n, state in stretches:
            for t, end in auto.ends[state]:
                assert templates[t][end + 1 - n:end + 1] == text[start:start + n]


def brute(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    places = [(i, l) for p, l in PHRASES.items() for k in [p.split()] for i in range(len(words)) if words[i:i + len(k)] == k]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({l for _, l in places}))


def test_edges_names_and_templates(spark, nothing):
    first = dict(reversed(TEMPLATES))                    # the first passage of each label
    mit = first["mit"].split()
    rows = EDGES + [
        (100, "Licensed under the Apache License, Version 2.0. Apache  license CC-BY mit license"),
        (101, "GNU General Public License gnu general GNU GENERAL PUBLIC LICENSE"),
        (102, "intro " + " ".join(mit[:30]) + " changed words " + " ".join(mit[30:]) + " outro"),
        (103, first["bsd"].upper()), (104, "permission is hereby granted to nobody")]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, rows)).collect()}
    for i, t in rows:
        if i is not None:
            r = got[i]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t)
            assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert got[102].labels == "mit" and got[102].spans[0].first == 1 and got[103].labels == "bsd" and got[104].labels == ""
    assert scan_licenses(nothing).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = scan_licenses(docs).collect()
    assert len(got) == len(texts) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])


def test_chains_keep_order():
    a = Automaton([list("abcdefghij")], [])
    codes = lambda s: np.array([a.vocab.get(c, 0) for c in s])
    run = lambda s: chain(a, scan(a, codes(s))[1])
    assert run("abcdefghij") == [(0, 10, 0, 9)]
    assert run("abczzdefghij") == [(0, 10, 0, 11)]
    assert max(c[1] for c in run("fghij" + "abcde")) == 5


def labels_of(spark, *texts):
    got = {r.doc_id: r for r in scan_licenses(frame(spark, list(enumerate(texts)))).collect()}
    return [(got[i].labels, [(x.label, x.first, x.last) for x in got[i].spans]) for i in range(len(texts))]


def test_every_passage_gets_its_own_label(spark):
    got = labels_of(spark, *[f"// {text} // and so on" for _, text in TEMPLATES])
    for (label, text), (labels, spans) in zip(TEMPLATES, got):
        assert label in labels.split(",") and spans[0][0] == label, (label, text, labels)
        base = {PHRASES[p] for p in PHRASES if p in " ".join(words_of(text))}
        assert set(labels.split(",")) == {label} | base, (label, labels)


def test_copies_one_after_the_other(spark):
    notice = dict(reversed(TEMPLATES))["isc"]
    n = len(words_of(notice))
    (labels, spans), = labels_of(spark, " ".join([notice] * 3))
    assert labels == "isc" and [x[1:] for x in spans] == [(k * n, (k + 1) * n - 1) for k in range(3)]


def test_the_best_span_wins():
    spans = [("gpl", 0, 40, 0.8, 33), ("agpl", 0, 41, 1.0, 42), ("mit", 60, 90, 0.9, 30), ("x", 88, 120, 0.9, 30)]
    assert [x[0] for x in best_spans(spans)] == ["agpl", "mit", "x"]
