"""Operator 6: fingerprints, the covering guarantee, links and components."""

import random
import re

import xxhash

from tests.llm.conftest import EDGES, SMALL, frame
from tidewater.llm.components import smallest_reachable
from tidewater.llm.simhash import close_links, covering_masks, drop_near_copies, fingerprint, simhash_groups


def plain_fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_groups(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    fps = sorted({f for _, f in prints})
    root = components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin(a ^ b).count("1") <= 2])
    first = {}
    for i, f in prints:
        if i is not None:
            first[root[f]] = min(first.get(root[f], i), i)
    return sorted((str(i), f, str(first.get(root[f]))) for i, f in prints)


def rows_of(df):
    return sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in df.collect())


def test_fingerprint_is_the_plain_definition(spark):
    for _, t in EDGES:
        assert fingerprint(t) == plain_fingerprint(t)
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("ña b c",)], "t string").select(F.xxhash64("t").alias("h")).first().h
    assert got & (1 << 64) - 1 == fingerprint("ña b c")


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(2)
    assert len(masks) == 7
    for a in range(64):
        for b in range(a, 64):
            assert any(not (1 << a | 1 << b) & m for m in masks)


def test_links_have_the_components_of_all_pairs(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(200)}
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    chain = rng.getrandbits(64)
    for i in range(40):
        chain ^= 1 << (i * 7 % 64)
        fps.add(chain)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = components(signed, [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2])
    for limit in (64, 2):                                # 2: nearly every bucket takes the exact way for large ones
        links = [(r.a, r.b) for r in close_links(df, bucket_limit=limit).collect()]
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in links)
        assert components(signed, links) == want


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 180)] + [(7, 3), (3, 9)], "a long, b long")
    got = {r.node: r.root for r in smallest_reachable(links).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, 3: 3, 7: 3, 9: 3}


def test_shuffled_chain_and_valley(spark):
    rng, n = random.Random(5), 1200
    names = rng.sample(range(10 ** 6), n + 1)            # a chain of 1,200 links under shuffled labels
    valley = [2 * 10 ** 6 + abs(2 * i - 201) for i in range(201)]     # labels fall to the middle, then rise
    valley = [x * 2 + (i > 100) for i, x in enumerate(valley)]
    pairs = list(zip(names, names[1:])) + list(zip(valley, valley[1:]))
    rng.shuffle(pairs)
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(names, min(names)), **dict.fromkeys(valley, min(valley))}


def test_edges(spark, edges, nothing):
    assert rows_of(simhash_groups(edges)) == brute_groups(EDGES)
    left = drop_near_copies(edges)
    assert left.columns == edges.columns
    assert simhash_groups(nothing).count() == 0 and drop_near_copies(nothing).count() == 0


def test_near_copies_leave_one(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(1, base), (2, base + " more"), (3, base.replace("word7 ", "other ")), (4, "something else entirely here")]
    kept = {r.doc_id for r in drop_near_copies(frame(spark, rows)).collect()}
    groups = {}
    for i, _, c in brute_groups(rows):
        groups.setdefault(c, []).append(int(i))
    assert kept == {min(g) for g in groups.values()}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(simhash_groups(docs)) == brute_groups(rows)


def test_null_and_repeated_ids_are_told_apart(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(400)) for c in "ab")
    rows = [(1, a), (None, a + " "), (None, "a clean text of no id"), (2, b), (2, b), (2, "another text of id two"),
            (None, "one two three"), (None, "one two three"), (1, "more of id one")]
    left = sorted((str(r.doc_id), r.text) for r in drop_near_copies(frame(spark, rows)).collect())
    assert left == sorted((str(i), t) for i, t in (rows[0], *rows[2:4], *rows[5:7], rows[8]))
