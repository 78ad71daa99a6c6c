"""Operator 1 against an alignment of every document with every item."""

import itertools

import numpy as np

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm import decontaminate
from tidewater.llm.decontaminate import (MASKS, MIN_ITEM, MIN_MATCH, PENALTY, SHORT_SHARE, best_stretch,
                                         drop_contaminated, overlaps, words_of)

ITEM = ("The quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree and the river "
        "runs quietly past the mill at dawn")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long").select("item_id", "text", "doc_id")


def brute(docs, bench):
    found = set()
    for i, t in docs:
        x = np.array(words_of(t), object)
        for j, s in bench:
            y = np.array(words_of(s), object)
            for d in range(-len(y) + 1, len(x)):
                lo, hi = max(0, d), min(len(x), d + len(y))
                if hi - lo >= 5 and best_stretch(x[lo:hi] == y[lo - d:hi - d])[0] >= MIN_MATCH:
                    found.add((i, j))
                    break
    return found


def test_substitutions_partial_copies_and_clean_text(spark):
    w = ITEM.split()
    swapped = [x if i % 9 else "CHANGED" for i, x in enumerate(w)]
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [(1, filler + " " + ITEM + " " + filler), (2, filler + " " + " ".join(swapped)), (3, filler),
            (4, " ".join(w[5:22]) + " " + filler), (5, " ".join(w[:7]) + " " + filler + " " + " ".join(w[9:15])),
            (6, ITEM.upper().replace(" ", ", ")), (None, ITEM), (7, "tiny item words stand right here yes")]
    bench = items(spark, [(10, ITEM, 1), (11, "tiny item words stand right here", 2), (12, None, 3), (13, "", 4), (14, "two words", 5)])
    got = {(r.doc_id, r.item_id) for r in overlaps(frame(spark, docs + EDGES), bench).collect()}
    assert got == {(1, 10), (2, 10), (4, 10), (6, 10), (None, 10), (7, 11)}
    first = {r.doc_id: (r.first_word, r.n_equal) for r in overlaps(frame(spark, docs), bench).collect()}
    assert first[1] == (300, len(w)) and first[4] == (0, 17)
    left = drop_contaminated(frame(spark, docs), bench)
    assert left.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 5]


def test_seeds_ignore_positions():
    assert any("." in m for m in MASKS) and all(m[0] == m[-1] == "#" for m in MASKS)


def test_repeated_rows_and_empty_tables(spark, nothing):
    bench = items(spark, [(1, ITEM, 1), (2, ITEM, 1)])
    got = [tuple(r)[:2] for r in overlaps(frame(spark, [(1, ITEM), (1, ITEM)]), bench).collect()]
    assert sorted(got) == [(1, 1), (1, 2)]
    assert overlaps(nothing, bench).count() == 0
    assert overlaps(frame(spark, [(1, ITEM)]), items(spark, [])).count() == 0
    assert drop_contaminated(frame(spark, [(1, ITEM), (2, None)]), items(spark, [])).count() == 2


def test_whole_table(spark):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in overlaps(docs, bench).collect()}
    short = docs.filter("n_chars < 4000")                # the alignment of everything is slow
    rows = [(r.doc_id, r.text) for r in short.collect()]
    want = brute(rows, [(r.item_id, r.text) for r in bench.collect()])
    assert want == {x for x in got if x[0] in {i for i, _ in rows}} and want


def test_null_and_repeated_ids_keep_their_clean_rows(spark):
    rows = [(None, ITEM), (None, "a clean text of no id"), (1, ITEM), (1, "a clean text of id one"), (2, "clean")]
    left = drop_contaminated(frame(spark, rows), items(spark, [(10, ITEM, 1)])).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted((str(i), t) for i, t in (rows[1], *rows[3:]))


def test_masks_find_every_pattern_of_short_items():
    for n in range(MIN_ITEM, 17):
        masks = [[i for i, c in enumerate(m) if c == "#"] for m in (*MASKS, *decontaminate.SHORT_MASKS.get(n, ())) if len(m) <= n]
        for bits in itertools.product((True, False), repeat=n):
            if 3 * sum(bits) < 2 * n and n < MIN_MATCH / SHORT_SHARE:
                continue                                 # too few equal words to be accepted
            m = best_stretch(np.array(bits))[0]
            if m >= MIN_MATCH or n < MIN_MATCH / SHORT_SHARE and m >= max(MIN_ITEM, SHORT_SHARE * n):
                assert any(all(bits[s + i] for i in k) for k in masks for s in range(n - k[-1])), bits


def test_masks_find_every_pattern_of_any_length():
    """All stretches without a window of a mask, as states (last words, words,
    score, highest score so far, equal words): none gets to be accepted."""
    kept = [(len(m), int(m.replace("#", "1").replace(".", "0"), 2)) for m in MASKS]
    wide = max(map(len, MASKS))
    seen, todo = set(), [(0, 0, 0, 0, 0)]
    while todo:
        last, n, score, top, equal = todo.pop()
        for hit in (1, 0):
            now = score + (1 if hit else -PENALTY)
            bits, k = (last << 1 | hit) & ((1 << wide) - 1), min(n + 1, wide)
            if now < 0 or any(k >= size and bits & m == m for size, m in kept):
                continue
            state = (bits, k, now, max(top, now), min(MIN_MATCH, equal + hit))
            assert now < 50 and not (hit and now > top and state[4] >= MIN_MATCH), state
            if state not in seen:
                seen.add(state)
                todo.append(state)


def test_regular_substitutions_and_short_items(spark):
    long = [f"word{i}" for i in range(59)]
    short = [[f"{c}{i}" for i in range(n)] for n, c in ((6, "a"), (8, "b"), (9, "c"))]
    bench = items(spark, [(i, " ".join(w), 1) for i, w in enumerate((long, *short))])
    fourth = [w if i % 4 != 3 else "other" for i, w in enumerate(long)]
    inner = [[w if i != at else "other" for i, w in enumerate(x)] for at, x in zip((2, 2, 4), short)]
    docs = [(i, "some text before " + " ".join(w) + " and after") for i, w in enumerate((fourth, *inner))]
    got = {(r.doc_id, r.item_id): r.n_equal for r in overlaps(frame(spark, docs), bench).collect()}
    assert got == {(0, 0): 45, (1, 1): 5, (2, 2): 7, (3, 3): 8}


def test_candidates_grow_with_the_text(spark, monkeypatch):
    """A text that repeats an item: what is compared grows like the text, not its square."""
    item = " ".join(f"word{i}" for i in range(50))
    bench, seen = items(spark, [(1, item, 1)]), []

    def counted(frame, fn, schema):
        if fn is decontaminate.verify:
            seen.append(frame.selectExpr("sum(octet_length(ids)) AS n").first()["n"])
        return plain(frame, fn, schema)

    plain = decontaminate.map_arrow
    monkeypatch.setattr(decontaminate, "map_arrow", counted)
    for times in (40, 160):
        got = overlaps(frame(spark, [(1, f"{item} " * times)]), bench).collect()
        assert [(r.doc_id, r.item_id, r.n_equal) for r in got] == [(1, 1, 50)]
    assert seen[0] >= 40 * 50 * 8 and seen[1] < 5 * seen[0]
