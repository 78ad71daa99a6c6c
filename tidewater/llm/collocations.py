"""Phrase collocations from weighted acyclic automata (operator 12).

Words: A-Z lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are runs of
``[^\\x20\\x09]+`` inside a piece. Everything is per language.

1. Shards: a task codes its words and, every ``SHARD_WORDS`` words, sorts the
   distinct phrases of the shard and builds their count automata
   (``automata.py``), one per prefix range. The borders of the ranges are
   quantiles of the phrases of a small sample, so a frequent first word or pair
   spans several ranges; they steer balance only.
2. Union: the automata of one prefix range meet in one task, which sums their
   weights as they stream in and keeps phrases of ``min_count`` and more.
3. Longer phrases: a phrase of three words is counted only if both pairs in it
   are frequent. A bitmap of fixed size stands for the frequent pairs; a false
   hit costs a count and changes nothing.
4. Parts: the distinct parts of all candidates go to the range that holds them
   and are composed with its automaton, which gives their counts.

Scores are exact: products are decimals of 38 digits, which hold 10^6 times the
square of any count below 10^15.

Defined results: null texts count as empty; a null language is ``und``; null ids
and repeated rows count like any other; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.automata import Automaton, cut_points, narrowed, range_of, summed, united
from tidewater.llm.common import bitmap, cut, map_arrow, shared_folder, slices
from tidewater.llm.runs import mixed

by_value(__name__)

SHARD_WORDS = 1_000_000
UNION_PHRASES = 800_000
RANGE_BYTES = 8 << 20
SAMPLE_ROWS, SAMPLE_CHARS = 1000, 4000
SALTS = 16
BITS = 1 << 26
#: Separators become a word of their own, which no text can hold.
PREPARED = bytes(46 if i in b".,;:!?\n\v\f\r" else 32 if i == 9 else i for i in range(256))


def tokens(texts: list) -> list[bytes]:
    """Words of the texts; ``b"."`` stands between pieces and texts."""
    raw = b".".join([t.encode() for t in texts if t])
    return raw.lower().translate(PREPARED).replace(b".", b" . ").split()


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def pair_bits(words: list[bytes], left, right, lang: str):
    """Bit numbers of pairs of word numbers (from 1)."""
    import numpy as np
    import xxhash

    own = np.fromiter([0, *map(xxhash.xxh3_64_intdigest, words)], np.uint64, len(words) + 1)
    h = own[left] * np.uint64(0x9E3779B97F4A7C15) + own[right] + np.uint64(xxhash.xxh3_64_intdigest(lang))
    return mixed(h) & np.uint64(BITS - 1)


def phrase_table(words: list[bytes], codes, depths: tuple, lang: str, frequent) -> tuple:
    """The counted phrases of a shard. ``codes``: its word numbers in text order,
    0 between pieces; ``frequent``: bitmap of pairs for phrases of three words."""
    import numpy as np

    found = []
    if 1 in depths:
        one = codes[codes > 0]
        found.append(np.stack([one, np.zeros_like(one), np.zeros_like(one)], axis=1))
    pair = (codes[:-1] > 0) & (codes[1:] > 0)
    if 2 in depths:
        at = np.flatnonzero(pair)
        found.append(np.stack([codes[at], codes[at + 1], np.zeros_like(at)], axis=1))
    if 3 in depths:
        at = np.flatnonzero(pair)
        bits = pair_bits(words, codes[at], codes[at + 1], lang)
        known = np.zeros(len(pair), bool)
        known[at] = (frequent[bits >> np.uint64(6)] >> (bits & np.uint64(63)) & np.uint64(1)).astype(bool)
        at = np.flatnonzero(known[:-1] & known[1:])
        found.append(np.stack([codes[at], codes[at + 1], codes[at + 2]], axis=1))
    parts = [summed(rows, np.ones(len(rows), np.int64)) for rows in found]
    rows, counts = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return words, rows, counts


class Ranges:
    """Prefix ranges: sorted border phrases of every sampled language. A language
    that the sample missed is dealt by its first words."""

    def __init__(self, borders: dict[str, list[tuple]], n: int):
        self.borders, self.n, self.offset, at = borders, n, {}, 0
        for lang in sorted(borders):
            self.offset[lang] = at
            at += len(borders[lang]) + 1

    def of(self, lang: str, phrase: tuple) -> int:
        import zlib

        if lang in self.borders:
            return (self.offset[lang] + range_of(phrase, self.borders[lang])) % self.n
        return zlib.crc32(lang.encode() + b" " + phrase[0]) % self.n

    def split(self, lang: str, table: tuple):
        """(range, rows of the table) of every range that has any."""
        import numpy as np

        rows = len(table[1])
        if lang in self.borders:
            edges = [0, *cut_points(table, self.borders[lang]), rows]
            for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
                if hi > lo:
                    yield (self.offset[lang] + i) % self.n, np.arange(lo, hi)
        else:
            part = np.array([0] + [self.of(lang, (w,)) for w in table[0]])[table[1][:, 0]]
            for i in np.unique(part).tolist():
                yield i, np.flatnonzero(part == i)


def shard_automata(depths: tuple, ranges: Ranges, frequent=None):
    """Rows (lang, text) to rows (lang, part, words, automaton)."""

    def run(batches):
        import itertools

        import numpy as np
        import pyarrow as pa

        held: dict[str, tuple] = {}

        def flush():
            rows = {"lang": [], "part": [], "words": [], "automaton": []}
            for lang, (numbers, arrays) in held.items():
                codes = np.concatenate(arrays)
                words = sorted(itertools.islice(numbers, 1, None))
                to = np.zeros(len(words) + 1, np.int64)
                to[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))] = np.arange(1, len(words) + 1)
                codes = to[codes]
                table = phrase_table(words, codes, depths, lang, frequent and frequent.value)
                n = int((codes > 0).sum())
                for part, own in ranges.split(lang, table):
                    rows["lang"].append(lang)
                    rows["part"].append(part)
                    rows["words"].append(n)
                    rows["automaton"].append(Automaton.build(narrowed(table, own)).to_bytes())
                    n = 0                                # a shard's words count once
            held.clear()
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("lang", pa.string()), ("part", pa.int32()), ("words", pa.int64()), ("automaton", pa.binary())]))

        size = 0
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in slices(texts):
                by_lang: dict[str, list] = {}
                for lang, text in zip(langs[lo:hi], texts[lo:hi]):
                    by_lang.setdefault(lang, []).append(text)
                for lang, own in by_lang.items():
                    words = tokens(own)
                    numbers, arrays = held.setdefault(lang, (_Numbers({b".": 0}), []))
                    arrays.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                    arrays.append(np.zeros(1, np.int32))
                    size += len(words)
                if size > SHARD_WORDS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def unite(min_count: int):
    """Rows (part, lang, automaton) in order of part and lang to one automaton
    each, of the phrases that reach ``min_count``."""

    def run(batches):
        import pyarrow as pa

        tables, key, size = [], None, 0

        def finished():
            table = united(tables)
            table = narrowed(table, table[2] >= min_count)
            if len(table[1]):
                yield pa.RecordBatch.from_pydict(
                    {"lang": [key[1]], "part": pa.array([key[0]], pa.int32()),
                     "automaton": pa.array([Automaton.build(table).to_bytes()], pa.binary())})

        for batch in batches:
            for part, lang, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, lang) != key and tables:
                    yield from finished()
                    tables, size = [], 0
                key = part, lang
                tables.append(Automaton.from_bytes(raw).table())
                size += len(tables[-1][1])
                if size > UNION_PHRASES and len(tables) > 1:
                    tables = [united(tables)]
                    size = len(tables[0][1]) // 2        # room to grow before the next union
        if tables:
            yield from finished()

    return run


def phrases(batches):
    """Rows (lang, automaton) to rows (lang, phrase, n_words, f)."""
    import pyarrow as pa

    for batch in batches:
        for lang, raw in zip(*(c.to_pylist() for c in batch.columns)):
            words, codes, counts = Automaton.from_bytes(raw).table()
            for lo in range(0, len(codes), 20_000):
                rows = [[words[i - 1] for i in r if i] for r in codes[lo:lo + 20_000].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), pa.array([b" ".join(r) for r in rows], pa.string()),
                     pa.array([len(r) for r in rows], pa.int32()), pa.array(counts[lo:lo + 20_000], pa.int64())],
                    names=["lang", "phrase", "n_words", "f"])


def numbered(ranges: Ranges):
    """Rows (lang, phrase) with the range of the phrase."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            part = [ranges.of(lang, tuple(p.encode().split(b" ")))
                    for lang, p in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=["lang", "phrase", "part"])

    return run


def composed(asked, held):
    """Counts of the asked phrases of one language and range."""
    import pandas as pd

    asked = asked.assign(key=[tuple(p.encode().split(b" ")) for p in asked["phrase"]]).sort_values("key")
    counts = [0] * len(asked)
    for raw in held["automaton"]:
        counts = Automaton.from_bytes(raw).compose(asked["key"].tolist())
    return pd.DataFrame({"lang": asked["lang"], "phrase": asked["phrase"], "f": pd.Series(counts, asked.index, "int64")})


def sample_ranges(docs: DataFrame, depth: int, n: int, share: float) -> Ranges:
    """About ``n`` ranges from the phrases of about ``SAMPLE_ROWS`` rows."""
    rows = docs.sample(share, seed=7).select("lang", F.substring("text", 1, SAMPLE_CHARS)).collect()
    seen: dict[str, set] = {}
    for lang, text in rows:
        words = tokens([text])
        seen.setdefault(lang, set()).update(p for p in zip(*(words[i:] for i in range(depth))) if b"." not in p)
    total = sum(map(len, seen.values()))
    borders = {}
    for lang, own in seen.items():
        if own:
            wanted, ordered = max(1, round(n * len(own) / total)), sorted(own)
            borders[lang] = sorted({ordered[i * len(ordered) // wanted] for i in range(1, wanted)})
    return Ranges(borders, n)


def count_automata(docs: DataFrame, depths: tuple, ranges: Ranges, min_count: int, frequent=None) -> tuple[DataFrame, DataFrame]:
    """(lang, part, automaton) of the phrases that reach ``min_count``, and
    (lang, n) with the number of words."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "count-shards")
    (map_arrow(docs.select("lang", "text"), shard_automata(depths, ranges, frequent),
               "lang string, part int, words long, automaton binary").write.option("compression", "zstd").parquet(folder))
    shards = spark.read.parquet(folder)
    met = shards.select("part", "lang", "automaton").repartitionById(ranges.n, F.col("part")).sortWithinPartitions("part", "lang")
    return (cut(map_arrow(met, unite(min_count), "lang string, part int, automaton binary")),
            cut(shards.groupBy("lang").agg(F.sum("words").alias("n"))))


def frequent_pairs(counted: DataFrame):
    """The bitmap of all counted pairs."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for lang, raw in zip(*(c.to_pylist() for c in batch.columns)):
                words, codes, _ = Automaton.from_bytes(raw).table()
                own = codes[codes[:, 1] > 0]
                bits = np.unique(pair_bits(words, own[:, 0], own[:, 1], lang)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64())], names=["bit"])

    return bitmap(map_arrow(counted.select("lang", "automaton"), run, "bit long"), BITS)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10,
                 contained_percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` collocations of each
    language: phrases of two or three words seen ``min_count`` times, by score
    ``floor(10^6 a^2 / (l r))`` of their weakest cut. A phrase inside a longer
    candidate that has ``contained_percent`` of its count is left out."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // RANGE_BYTES))
    share = min(1.0, SAMPLE_ROWS / max(size["rows"], 1))
    ranges = sample_ranges(rows, 2, n, share)
    counted, words_of_lang = count_automata(rows, (1, 2), ranges, min_count)
    frequent = spark.sparkContext.broadcast(frequent_pairs(counted))
    longer, _ = count_automata(rows, (3,), sample_ranges(rows, 3, n, share), min_count, frequent)

    kind = "lang string, phrase string, n_words int, f long"
    found = map_arrow(counted.unionByName(longer).select("lang", "automaton"), phrases, kind).filter("n_words > 1")
    w = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("n_words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(w, 1, k), " ").alias("left"),
        F.array_join(F.slice(w, k + 1, F.col("n_words")), " ").alias("right")))
    cut_rows = cut(found.select("lang", "phrase", "n_words", F.col("f").alias("a"), F.inline(cuts)))
    asked = cut_rows.select("lang", F.explode(F.array("left", "right")).alias("phrase")).distinct()
    asked = map_arrow(asked, numbered(ranges), "lang string, phrase string, part int")
    parts = cut(asked.groupBy("lang", "part").cogroup(counted.groupBy("lang", "part"))
                .applyInPandas(composed, "lang string, phrase string, f long"))
    scored = (cut_rows.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .withColumn("score", F.expr("cast((cast(a as decimal(15)) * cast(a as decimal(15)) * cast(1000000 as decimal(7))) "
                                          "div (cast(l as decimal(15)) * cast(r as decimal(15))) as long)")))
    scored = cut(scored)
    inner = scored.filter("n_words = 3").select("lang", "a", F.inline(F.array(
        F.struct(F.when(F.col("k") == 1, F.col("right")).otherwise(F.col("left")).alias("phrase"),
                 F.when(F.col("k") == 1, F.col("r")).otherwise(F.col("l")).alias("f")))))
    held = inner.filter(F.lit(100) * F.col("a") >= F.lit(contained_percent) * F.col("f")).select("lang", "phrase").distinct()
    best = (scored.groupBy("lang", "phrase", "a")
            .agg(F.min_by(F.struct("score", "l", "r"), F.struct("score", "k")).alias("best"))
            .select("lang", "phrase", "a", "best.*").join(held, ["lang", "phrase"], "left_anti"))
    # the best of each of SALTS stretches of a language first: one task never ranks more than SALTS * top rows
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return (ranked.join(words_of_lang, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
