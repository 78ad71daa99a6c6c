"""Operators 3, 4 and 9: held-out accuracy, and the parts against plain forms."""

import itertools
import zlib

import numpy as np
import pytest

from tests.llm.conftest import CHECK, EDGES, frame
from tidewater.llm import common, language, quality, toxicity


def fold(i, k):
    return zlib.crc32(str(i).encode()) % k


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet")
    return docs, spark.read.parquet(f"{CHECK}/labels.parquet")


def test_language_held_out(spark, tables, nothing):
    docs, _ = tables
    model = language.train_language_model(docs, per_language=60)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    held = [(r.lang, got[r.doc_id]) for r in docs.select("doc_id", "lang").collect() if fold(r.doc_id, 5) == 0]
    assert np.mean([a == b.lang_pred for a, b in held]) > 0.97
    edge = language.identify(frame(spark, EDGES), model).collect()
    assert len(edge) == len(EDGES) and all(0 <= r.score <= 1 for r in edge)
    assert {r.lang_pred for r in edge if r.doc_id in (3, 4, 5, 11, 12)} == {"und"}
    kept = language.keep_identified(frame(spark, EDGES), model)
    assert kept.columns == nothing.columns and not {r.doc_id for r in kept.collect()} & {3, 4, 5, 11, 12}
    assert language.identify(nothing, model).count() == 0
    none = language.train_language_model(nothing)
    assert {r.lang_pred for r in language.identify(frame(spark, EDGES), none).collect()} == {"und"}
    assert language.keep_identified(frame(spark, EDGES), none).count() == 0


def test_language_labels_code_switched_words(tables):
    docs, _ = tables
    rows = [(r.text, r.lang) for r in docs.filter("n_chars < 4000").select("text", "lang").collect()][:400]
    model = language.fit(rows, epochs=12)
    a = next(t for t, l in rows if l == "de" and len(t) > 600)
    b = next(t for t, l in rows if l == "es" and len(t) > 600)
    mixed = language.words_of(a)[:30] + language.words_of(b)[:30]
    mass, n = language.label_mass([" ".join(mixed)], model)
    share = dict(zip(model["langs"], mass[0] / n[0]))
    assert share["de"] > 0.3 and share["es"] > 0.3


def test_forward_backward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    scores, trans, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    post, pairs = language.forward_backward(scores, np.ones((1, 4), bool), trans, start)
    weight, by_word, by_pair = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(start[path[0]] + sum(scores[0, i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        weight += w
        for i, y in enumerate(path):
            by_word[i, y] += w
        for a, b in zip(path, path[1:]):
            by_pair[a, b] += w
    assert np.allclose(post[0], by_word / weight) and np.allclose(pairs, by_pair / weight)
    short = language.marginals(np.concatenate([scores, rng.normal(size=(1, 2, 3))], 1).transpose(1, 0, 2),
                               np.array([[1], [1], [1], [1], [0], [0]], bool), trans, start)
    assert np.allclose(short[:4, 0], by_word / weight)


def test_toxicity_held_out(spark, tables, nothing):
    docs, labels = tables
    model = toxicity.train_toxicity_model(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if fold(r.doc_id, 3) == 1 and r.doc_id in got]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) > 0.9          # area under the ROC curve
    assert set(model["thresholds"]) >= {None}
    edge = toxicity.toxicity(frame(spark, EDGES), model).collect()
    assert len(edge) == len(EDGES) and all(0 <= r.score <= 1 and 0 < r.lang_threshold <= 1 for r in edge)
    assert toxicity.toxicity(nothing, model).count() == 0
    none = toxicity.train_toxicity_model(nothing, labels.limit(0))
    assert {r.score for r in toxicity.toxicity(frame(spark, EDGES), none).collect()} == {0.0}


def test_toxicity_scores_are_the_plain_convolution():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["aa", "bbbb", "cccccc", "ddddddd", "toxic"], 30)) for _ in range(60)] + ["", "one"]
    model = toxicity.fit(texts, [int("toxic toxic" in t) for t in texts], epochs=1)
    for t, s in zip(texts, toxicity.score(texts, model)):
        words = toxicity.words_of(t) + [""] * 3
        e = toxicity.table_rows(words, model["table"])
        e[[not w for w in words]] = 0
        top = [max([0.0] + [b[f] + sum(e[i + j] @ bank[j][:, f] for j in range(w)) for i in range(len(words) - 3)])
               for w, bank, b in zip(toxicity.WIDTHS, model["filters"], model["bias"]) for f in range(toxicity.FILTERS)]
        assert abs(s - 1 / (1 + np.exp(-(np.array(top) @ model["out"] + model["shift"])))) < 1e-4


def test_quality_held_out(spark, tables, nothing):
    docs, labels = tables
    model = quality.train_quality_model(docs, labels)
    got = {r.doc_id: r.score for r in quality.quality(docs, model).collect()}
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if fold(r.doc_id, 3) == 1 and r.doc_id in got]
    assert np.mean([(s >= 0.5) == y for y, s in held]) > 0.9
    edge = quality.quality(frame(spark, EDGES), model).collect()
    assert len(edge) == len(EDGES) and all(0 <= r.score <= 1 for r in edge)
    assert quality.quality(nothing, model).count() == 0
    none = quality.train_quality_model(nothing, labels.limit(0))
    assert {r.score for r in quality.quality(frame(spark, EDGES), none).collect()} == {0.5}


def test_trees_walk_like_single_rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit(x, y, trees=20)
    p = quality.predict(x, model)
    assert np.mean((p >= 0.5) == y) > 0.95
    for i in range(0, 400, 37):
        z = model["base"]
        for f, t, v in zip(model["feature"], model["threshold"], model["value"]):
            node = 0
            for _ in range(model["depth"]):
                node = 2 * node + 1 + int(x[i, f[node]] > t[node])
            z += v[node - (2 ** model["depth"] - 1)]
        assert abs(p[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_training_samples_are_bounded(spark):
    """One id may hold a third of all rows, drawn or not: never more than asked."""
    rows = [(7 if i % 3 == 0 else i, f"text {i} " * 3, "en" if i % 2 else "fr") for i in range(900)]
    docs = frame(spark, rows).select("doc_id", "text", "lang")
    for per_label in (1, 5, 400):
        for seed in range(3):
            shifted = docs.withColumn("doc_id", docs["doc_id"] + 1000 * seed)
            drawn = shifted.filter(common.draw(shifted, "lang", "doc_id", per_label))
            kept = common.at_most(drawn, "lang", per_label, "doc_id", "text").collect()
            assert max([sum(r.lang == x for r in kept) for x in ("en", "fr")]) <= per_label
    everything = common.at_most(docs, "lang", 10, "doc_id", "text").collect()
    assert sorted(r.lang for r in everything) == ["en"] * 10 + ["fr"] * 10
    assert sorted(map(tuple, everything)) == sorted(map(tuple, common.at_most(docs.repartition(5), "lang", 10, "doc_id", "text").collect()))


def test_repeated_labels_and_ids_train(spark):
    docs = frame(spark, [(i % 40, ("bad awful " if i % 40 % 2 else "good fine ") * 5 + str(i), "en") for i in range(400)])
    labels = spark.createDataFrame([(i % 40, i % 2, i % 2) for i in range(400)], "doc_id long, toxic int, quality int")
    assert len(toxicity.train_toxicity_model(docs, labels, per_class=6)["model"]) > 0
    assert quality.train_quality_model(docs, labels, per_class=6) is not None


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only few of many positives hold, and only beyond 64 KiB, counts:
    no row is left out for the size of the table or of its text."""
    plain = [(i, ("good day to all of you " * 3) + str(i % 7), "en") for i in range(3000)]
    bad = [(10_000 + i, "awful nasty words here " * 3 + str(i % 5), "en") for i in range(2000)]
    long = [(20_000 + i, "good day " * 9000 + "zzyzx", "en") for i in range(40)]
    docs = frame(spark, plain + bad + long).select("doc_id", "text", "lang")
    labels = spark.createDataFrame([(r[0], int(r[0] >= 10_000)) for r in plain + bad + long], "doc_id long, toxic int")
    got = toxicity.labelled_rows(docs, labels, "doc_id", "text", "toxic", "lang")
    assert got.count() == sum(fold(r[0], 3) != 1 for r in plain + bad + long)
    model = toxicity.train_toxicity_model(docs, labels)["model"]
    same = toxicity.train_toxicity_model(docs.repartition(7), labels.repartition(3))["model"]
    assert np.array_equal(model["table"], same["table"]) and model["shift"] == same["shift"]
    a, b, c, d = toxicity.score(["good day zzyzx", "good day", "nasty words", ""], model)
    assert a > 0.5 > b and c > 0.5 > d


def test_labelled_texts_are_shuffled_once(spark):
    rows = [(i % 60 or None, f"text {i % 90}", "en") for i in range(300)]
    docs = frame(spark, rows).select("doc_id", "text", "lang")
    labels = spark.createDataFrame([(i, y) for i in range(0, 80, 2) for y in {0, i % 4 // 2}] * 2, "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = toxicity.labelled_rows(docs, labels, "doc_id", "text", "toxic", "lang", 3)
        plan = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        shuffled = [x for x in plan.split("\n\n") if ") Exchange\n" in x and " text#" in x.replace("[text#", "[ text#")]
        assert len(shuffled) == 1 and got.rdd.getNumPartitions() == 3
        have = sorted((r.id, r.text, r.lang, r.label) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    given = {(i, y) for i in range(0, 80, 2) for y in {0, i % 4 // 2} if fold(i, 3) != 1}
    assert have == sorted((i, t, lang, y) for i, t, lang in rows for k, y in given if i == k)


def test_peaks_by_block_are_those_of_the_whole_text():
    rng = np.random.default_rng(5)
    flat, words, starts = toxicity.layout([[f"w{k}" for k in rng.integers(0, 50, n)] for n in (40, 0, 1, 200, 7)])
    e = rng.normal(size=(len(words), toxicity.DIM)).astype(np.float32)
    e[0] = 0
    filters = [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    for x, y in zip(toxicity.peaks(flat, starts, e, filters), toxicity.peaks(flat, starts, e, filters, 16)):
        assert all(np.allclose(a, b) for a, b in zip(x, y))


def test_thresholds_are_order_statistics_of_all_negatives(spark):
    rng = np.random.default_rng(6)
    rows = [("en" if i % 3 else "fr", int(i % 10 == 0), float(rng.random())) for i in range(3000)] + [("xx", 0, 0.9)]
    got = toxicity.calibrate(spark.createDataFrame(rows, "lang string, label int, score double"), max_false=0.05)
    assert set(got) == {None, "en", "fr"}
    for lang, limit in got.items():
        own = [s for x, y, s in rows if y == 0 and lang in (None, x)]
        assert np.mean([s >= limit for s in own]) <= 0.05 < np.mean([s >= limit - 0.01 for s in own])
