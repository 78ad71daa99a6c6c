"""Substring dedup with suffix automata of reference shards (operator 13).

A word goes if a window of ``window`` words covers it whose word sequence also
starts earlier: in a document with a smaller id, or earlier in the same one.

1. Anchors: the smallest hash among the grams of a window names the window; equal
   windows have equal names, and neighbours mostly share one, so a document falls
   into pieces, stretches of windows of one name. Names seen once in the whole
   corpus hold no repeated window. The others are marked in a bitmap of fixed
   size; a false mark costs work and changes nothing.
2. Pieces under marked names are grouped by their content, map-side first, and the
   earliest place (document, word) of each content is kept. A piece whose content
   stands elsewhere earlier goes whole. What is left to find are windows that
   different pieces share; only names with several contents can have them.
3. Reference shards: the distinct pieces of a few such names make one shard. Its
   generalised suffix automaton knows the earliest place where each state's
   stretches end; the shard's pieces are streamed through it, and where the
   matching statistics reach ``window`` words the state tells whether that window
   was there before. An automaton goes to the task that holds the pieces of its
   names and not to all tasks, since all automata together grow with the corpus.
   The contents of a name with more than ``NAME_WORDS`` words (a line that stands
   before and after everything) would not fit: they go through the same steps
   again under names from longer grams, and in the end from whole windows, under
   which contents are windows and nothing is left to find.
4. The spans of a document are put together and its other words stay.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts
have no words; a null id comes before all others; rows that share an id count
as one document, so windows at the same word of them are not before one another;
repeated rows give equal results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import bitmap, cut, map_arrow, shared_folder, slices, worker_cache
from tidewater.operators.joins import bounded_broadcast
from tidewater.llm.runs import mixed

by_value(__name__)

WINDOW = 20
#: Words of the grams that name windows: shares of the window, from long pieces to single windows.
GRAMS = (0.3, 0.8, 1.0)
PIECE_WINDOWS = 512
NAME_WORDS = 60_000
SHARD_WORDS = 60_000
BITS = 1 << 26
BLOCK = 1 << 20                #: bytes of a text that are summed up at a time


def powers(n: int):
    """The first ``n`` or more powers of an odd number and of its inverse, mod 2^64."""
    import numpy as np

    cache, base = worker_cache("passages"), 0x9E3779B97F4A7C15
    if len(cache.get("powers", ())) < n:
        for name, x in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
            all_x = np.full(2 * n, x, np.uint64)
            all_x[0] = 1
            cache[name] = np.cumprod(all_x)
    return cache["powers"], cache["inverse"]


def word_places(raw: bytes):
    """(first byte, byte after the last, hash) of every word. A word's hash is the
    sum of its bytes' numbers times powers of their place in it, from running sums
    over the text; it depends on the word alone."""
    import numpy as np

    data = np.frombuffer(raw, np.uint8)
    edge = np.flatnonzero(np.diff((data == 32) | (data >= 9) & (data <= 13), prepend=True, append=True))
    starts, stops = edge[::2], edge[1::2]
    numbers, hashes = mixed(np.arange(1, 257, dtype=np.uint64)), np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(raw) + BLOCK, BLOCK))
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:                                      # the words that start in one block
            begin, end = starts[lo], stops[hi - 1]
            power, inverse = powers(int(end - begin) + 1)
            sums = np.zeros(end - begin + 1, np.uint64)
            np.cumsum(numbers[data[begin:end]] * power[:end - begin], out=sums[1:])
            hashes[lo:hi] = (sums[stops[lo:hi] - begin] - sums[starts[lo:hi] - begin]) * inverse[starts[lo:hi] - begin]
    return starts, stops, mixed(hashes)


def window_names(ids, ends, window: int, gram: int, longest: int):
    """(first window, windows, name, whether one window may stand twice in it) of
    all pieces. ``ids``: word hashes of several documents laid together,
    ``ends``: where each document ends; a piece has at most ``longest`` windows."""
    import numpy as np

    n = len(ids) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    grams = np.zeros(len(ids) - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + len(grams)]
    again = np.zeros(len(grams), bool)                   # a gram that stands again within one window's reach
    for lag in range(1, window - gram + 1):
        again[:-lag] |= grams[:-lag] == grams[lag:]
    again = np.append(0, np.cumsum(again))
    low, wide, span = mixed(grams), 1, window - gram + 1
    while wide < span:                                   # smallest hash of ``span`` grams from each place on
        more = min(wide, span - wide)
        low, wide = np.minimum(low[:len(low) - more], low[more:]), wide + more
    last = np.repeat(ends, np.diff(ends, prepend=0))[:n]  # end of the document of each place
    place = np.flatnonzero(np.arange(n) + window <= last)
    if not len(place):
        return place, place, low[:0], place > 0
    name = low[place]
    new = np.append(True, (np.diff(place) > 1) | (name[1:] != name[:-1]))
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(place)))
    parts = -(-size // longest)                          # long pieces are split
    own = np.repeat(np.arange(len(head)), parts)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)
    first, size = place[head][own] + nth * longest, np.minimum(longest, size[own] - nth * longest)
    return first, size, name[head][own], (size > span) | (again[first + size - 1 + span] > again[first])


def sliced(texts: list, window: int, gram: int):
    """Per slice of a batch: (first row, bytes of the rows, first byte and byte
    after the last of every word, words up to the end of each row, pieces as of
    ``window_names``)."""
    import numpy as np

    for lo, hi in slices(texts):
        rows = [t.encode() if t else b"" for t in texts[lo:hi]]
        raw = b" ".join(rows)
        starts, stops, ids = word_places(raw)
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in rows]) - 1)
        yield lo, raw, (starts, stops), ends, window_names(ids, ends, window, gram, 1 if gram == window else PIECE_WINDOWS)


def name_counts(window: int, gram: int):
    """Rows (text) to rows (name, n): pieces per name, a piece that may repeat a
    window in itself counting twice."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            names, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, _, _, _, (_, _, name, inner) in sliced(batch.column(0).to_pylist(), window, gram):
                names.append(name)
                sizes.append(1 + inner)
            name, at = np.unique(np.concatenate(names), return_inverse=True)
            n = np.bincount(at, np.concatenate(sizes), len(name)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(np.minimum(n, 2), pa.int32())], names=["name", "n"])

    return run


def marks(names: DataFrame):
    """The bitmap of the names, two bits each."""
    return bitmap(names.select(F.explode(F.array(
        F.col("name").bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned("name", 32).bitwiseAND(F.lit(BITS - 1)))).alias("bit")), BITS)


def marked(names, bits):
    """Which names (unsigned) are marked."""
    import numpy as np

    one, two = names & np.uint64(BITS - 1), (names >> np.uint64(32)) & np.uint64(BITS - 1)
    return (bits[one >> np.uint64(6)] >> (one & np.uint64(63)) & bits[two >> np.uint64(6)] >> (two & np.uint64(63))
            & np.uint64(1)).astype(bool)


def marked_pieces(shared, window: int, gram: int):
    """Rows (unit, doc_id, start, text) to the pieces under marked names; the
    content comes along with the first piece of a batch that has it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("row", "digest", "offset", "n", "inner", "content")}
            names, sent = [np.zeros(0, np.uint64)], set()
            for lo, raw, (starts, stops), ends, (first, size, name, inner) in sliced(batch.column(3).to_pylist(), window, gram):
                hit = np.flatnonzero(marked(name, shared.value))
                first, size, inner = first[hit], size[hit], inner[hit]
                row = np.searchsorted(ends, first, "right")
                offset = first - np.append(0, ends)[row]
                names.append(name[hit])
                begin, end = starts[first], stops[first + size + window - 2]
                for d, a, b, o, n, x in zip(*(v.tolist() for v in (row, begin, end, offset, size, inner))):
                    content = b" ".join(raw[a:b].split())
                    digest = hashlib.blake2b(content, digest_size=16).digest()
                    out["row"].append(lo + d)
                    out["digest"].append(digest)
                    out["offset"].append(o)
                    out["n"].append(n)
                    out["inner"].append(x)
                    out["content"].append(None if digest in sent else content)
                    sent.add(digest)
            take = pa.array(out["row"], pa.int64())
            offset = pa.array(out["offset"], pa.int64())
            start = pa.array(batch.column(2).to_numpy()[np.array(out["row"], np.int64)] + np.array(out["offset"], np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), start, offset, pa.array(np.concatenate(names).view(np.int64)),
                 pa.array(out["digest"], pa.binary()), pa.array(out["n"], pa.int32()), pa.array(out["inner"], pa.bool_()),
                 pa.array(out["content"], pa.binary())],
                names=["unit", "doc_id", "start", "offset", "name", "digest", "n", "inner", "content"])

    return run


def under_marks(shared):
    """Rows whose first column, a name, is marked."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(marked(names, shared.value)))

    return run


class SuffixAutomaton:
    """All stretches of the words of several sequences. ``step[s]``: word to
    state; ``link[s]``: state of the longest suffix that ends at more places;
    ``length[s]``: longest stretch; ``first[s]``: smallest key of a place where
    the stretches of s end."""

    def __init__(self, sequences: list[tuple[list, int]]):
        """``sequences``: (words, key of the first word); keys count up by word."""
        self.step, self.link, self.length, self.first = [{}], [-1], [0], [0]
        step, link, length, first = self.step, self.link, self.length, self.first
        for words, key in sequences:
            last = 0
            for w in words:
                last = self._grow(last, w)
                if first[last] > key:
                    first[last] = key
                key += 1
        for s in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            up = link[s]
            if first[up] > first[s]:
                first[up] = first[s]

    def _grow(self, last: int, w) -> int:
        step, link, length = self.step, self.link, self.length
        there = step[last].get(w)
        if there is not None:                            # the stretch is known; it may need a state of its own
            return there if length[there] == length[last] + 1 else self._part(last, w, there)
        new = self._new({}, 0, length[last] + 1)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._part(p, w, q)
        return new

    def _new(self, steps: dict, link: int, length: int) -> int:
        self.step.append(steps)
        self.link.append(link)
        self.length.append(length)
        self.first.append(1 << 200)
        return len(self.length) - 1

    def _part(self, p: int, w, q: int) -> int:
        """A state for the stretches of ``q`` no longer than those of ``p`` and w."""
        part = self._new(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = part
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = part
            p = self.link[p]
        return part

    def repeats(self, words: list, key: int, window: int) -> list[int]:
        """Windows (numbers of their first words) of a sequence of the automaton
        that end at a smaller key elsewhere."""
        step, link, length, first = self.step, self.link, self.length, self.first
        s, n, out = 0, 0, []
        for i, w in enumerate(words):
            s, n = step[s][w], n + 1
            if n >= window:
                n = window
                while length[link[s]] >= n:              # the state of the last ``window`` words
                    s = link[s]
                if first[s] < key + i:
                    out.append(i + 1 - window)
        return out


def shared_windows(window: int):
    """Rows (name, digest, doc_id, start, content) in order of the name, to rows
    (digest, gone): the windows of a content that stand earlier in another."""

    def run(batches):
        import pyarrow as pa

        held, size, last = [], 0, None

        def shard():
            ids = sorted({d for d, *_ in held}, key=lambda d: (d is not None, d or 0))
            rank = {d: i for i, d in enumerate(ids)}
            sequences = [(content.split(b" "), (rank[d] << 40) + start) for d, start, _, content in held]
            auto = SuffixAutomaton(sequences)
            gone = [auto.repeats(words, key, window) for words, key in sequences]
            hit = [i for i, g in enumerate(gone) if g]
            return pa.RecordBatch.from_arrays([pa.array([held[i][2] for i in hit], pa.binary()),
                                               pa.array([gone[i] for i in hit], pa.list_(pa.int32()))], names=["digest", "gone"])

        for batch in batches:
            for name, digest, doc_id, start, content in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SHARD_WORDS and name != last:
                    yield shard()
                    held, size = [], 0
                last = name
                held.append((doc_id, start, digest, content))
                size += content.count(b" ") + 1
        if held:
            yield shard()

    return run


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder."""
    folder = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def repeated_spans(units: DataFrame, window: int, level: int = 0) -> DataFrame:
    """(unit, offset, n, gone) of stretches of windows in ``units`` (unit, doc_id,
    start, text: words of a document from its word ``start`` on): the windows
    ``gone`` of the ``n`` from word ``offset`` on (null: all) stand earlier."""
    spark = units.sparkSession
    gram = max(1, round(window * GRAMS[level]))
    unit, doc_id = (units.schema[c].dataType.simpleString() for c in ("unit", "doc_id"))
    names = (map_arrow(units.select("text"), name_counts(window, gram), "name long, n int")
             .groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name"))
    shared = spark.sparkContext.broadcast(marks(names))
    pieces = kept(map_arrow(units.select("unit", "doc_id", "start", "text"), marked_pieces(shared, window, gram),
                            f"unit {unit}, doc_id {doc_id}, start long, offset long, name long, digest binary, n int, "
                            "inner boolean, content binary"), "pieces")
    place = F.struct("doc_id", "start")
    contents = kept(pieces.groupBy("digest", "name", "n").agg(F.min(place).alias("first"), F.max("inner").alias("inner"),
                                                              F.count(F.lit(1)).alias("places")), "contents")
    verdict = contents.select("digest", "first", "places")
    if gram < window:                                    # else contents are windows: none is shared by two
        verdict = verdict.join(shared_by_contents(pieces, contents, window, level), "digest", "left")
    else:
        verdict = verdict.withColumn("gone", F.lit(None).cast("array<int>"))
    verdict = verdict.filter((F.col("places") > 1) | F.col("gone").isNotNull())
    return (pieces.select("digest", "unit", "doc_id", "start", "offset", "n").join(verdict, "digest")
            .withColumn("own", F.col("first") == place).filter(~F.col("own") | F.col("gone").isNotNull())
            .select("unit", "offset", "n", F.when(F.col("own"), F.col("gone")).alias("gone")))


def shared_by_contents(pieces: DataFrame, contents: DataFrame, window: int, level: int) -> DataFrame:
    """(digest, gone): the windows of a content that stand earlier in another."""
    spark = pieces.sparkSession
    busy = cut(contents.groupBy("name").agg(F.count(F.lit(1)).alias("contents"), F.max("inner").alias("inner"),
                                            F.sum(F.col("n") + F.lit(window - 1)).alias("words"))
               .filter((F.col("contents") > 1) | F.col("inner")).select("name", "words"))
    shared = spark.sparkContext.broadcast(marks(busy))
    columns = pieces.select("name", "digest", "doc_id", "start", "content")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns.schema.fields)
    texts = (map_arrow(columns, under_marks(shared), kinds).groupBy("name", "digest")
             .agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max("content").alias("content"))
             .select("name", "digest", "first.doc_id", "first.start", "content"))
    wide = cut(busy.filter(F.col("words") > NAME_WORDS).select("name"))
    if wide.isEmpty():
        return map_arrow(texts.repartition("name").sortWithinPartitions("name"), shared_windows(window), "digest binary, gone array<int>")
    texts = kept(texts, "contents-of-shared-names")
    fitting = texts.join(bounded_broadcast(wide), "name", "left_anti")
    found = map_arrow(fitting.select(*texts.columns).repartition("name").sortWithinPartitions("name"), shared_windows(window),
                      "digest binary, gone array<int>")
    units = (texts.join(bounded_broadcast(wide), "name", "left_semi")
             .select(F.col("digest").alias("unit"), "doc_id", "start", F.col("content").cast("string").alias("text")))
    spans = repeated_spans(kept(units, "contents-of-wide-names"), window, level + 1)
    starts = F.when(F.col("gone").isNull(), F.expr("sequence(0, n - 1)")).otherwise(F.col("gone"))
    again = spans.select(F.col("unit").alias("digest"), F.transform(starts, lambda t: (t + F.col("offset")).cast("int")).alias("gone"))
    return found.unionByName(again.groupBy("digest").agg(F.flatten(F.collect_list("gone")).alias("gone")))


def without_spans(window: int):
    """Rows (doc_id, text, spans) to rows (doc_id, n_words, n_removed, removed, kept)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            total, gone, where, kept = [], [], [], []
            for text, own in zip(texts, spans):
                words = text.encode().split() if text else []
                out = []
                if own:
                    mark = np.zeros(len(words) + 1, np.int64)
                    for span in own:
                        starts = [span["offset"]] if span["gone"] is None else [span["offset"] + t for t in span["gone"]]
                        size = window - 1 + (span["n"] if span["gone"] is None else 1)
                        np.add.at(mark, starts, 1)
                        np.add.at(mark, [s + size for s in starts], -1)
                    off = np.append(np.cumsum(mark)[:-1] > 0, False)
                    edge = np.flatnonzero(np.diff(off, prepend=False))
                    out = list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))
                    left = [words[i] for i in np.flatnonzero(~off[:-1]).tolist()]
                else:
                    left = words
                total.append(len(words))
                gone.append(len(words) - len(left))
                where.append([{"first": a, "last": b} for a, b in out])
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(where, kind), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return run


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, the ``removed`` spans
    (first and last word, from 0) and the ``kept`` words joined by blanks."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_kind = source.schema["doc_id"].dataType.simpleString()
    keyed = source.withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))
    units = keyed.select(F.struct("doc_id", "row").alias("unit"), "doc_id", F.lit(0).cast("long").alias("start"), "text")
    spans = kept(repeated_spans(units, window)
                 .groupBy("unit").agg(F.collect_set(F.struct("offset", "n", "gone")).alias("spans"))
                 .select("unit.doc_id", "unit.row", "spans"), "spans")
    match = keyed["doc_id"].eqNullSafe(spans["doc_id"]) & (keyed["row"] == spans["row"])
    rows = keyed.join(spans, match, "left").select(keyed["doc_id"], keyed["text"], spans["spans"])
    return map_arrow(rows, without_spans(window), f"doc_id {id_kind}, n_words long, n_removed long, "
                     "removed array<struct<first:long,last:long>>, kept string")
