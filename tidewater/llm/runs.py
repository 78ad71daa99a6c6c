"""Periodic run detection by seed and extend on diagonals (operator 11).

A run is a stretch of words that repeats with its smallest period q, at least
``max(min_length, 2 q)`` words long, and that neither neighbour extends. On the
diagonal of lag q (word i against word i + q) it is a stretch of at least
``max(min_length - q, q)`` equal pairs, so a run guarantees an equal pair of
k-grams with k = ``min_length // 2`` for lags below 2 k, and with k doubled for
every doubling of the lag.

1. Index: hashes of the k-grams of each document. From k to 2 k only grams that
   repeat inside their document go on, so ordinary text leaves at the first k.
2. Seeds: pairs of occurrences of one k-gram at a lag in [k, 2 k). Occurrences
   at most k/2 apart form a chain with the gram's own period p and lie in one
   run of period p; pairs inside a chain are left out, as their lags are
   multiples of p. Between two chains a new run stands only on the diagonals
   that line up their first or last members, or, when the chains touch, on all
   their diagonals. So a word repeated n times costs n log n, not n squared.
3. Extend: seeds in order of (lag, place); a table of the furthest place covered
   on the lag lets only the first seed of a stretch be extended. Extension
   compares the words themselves, so a clash of hashes never makes a run.
4. A stretch whose lag is a multiple of a smaller period is dropped: the same
   run is found at that period.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts
have no words and no runs; null ids and repeated rows are scanned like any
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import map_arrow, slices

by_value(__name__)

MIN_LENGTH = 12


def planted_order(doc_id: int | None, n: int):
    """The contract's rewriting of every tenth document as positions of its
    words (None: as it stands): from a place on, one stretch repeats to the end."""
    import zlib

    import numpy as np

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None and n else 1
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def mixed(x):
    """A 64-bit hash of unsigned 64-bit numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(keys):
    """Which of the keys occur more than once (a few that do not may pass)."""
    import numpy as np

    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    bits = max(12, len(twice).bit_length() + 4)
    low = np.uint64((1 << bits) - 1)
    table = np.zeros(1 << bits, bool)
    table[(twice & low).astype(np.int64)] = True
    return table[(keys & low).astype(np.int64)]


def chain_seeds(places, keys, k: int, least: int):
    """(lag, place) of the seeds with a lag in [least, 2 k). ``places`` and
    ``keys`` are sorted by (key, place)."""
    import numpy as np

    near = (keys[1:] == keys[:-1]) & (np.diff(places) <= k // 2)
    head = np.flatnonzero(np.append(True, ~near))
    tail = np.append(head[1:], len(places)) - 1
    first, last, key = places[head], places[tail], keys[head]
    step = np.where(tail > head, places[np.minimum(head + 1, len(places) - 1)] - first, 0)
    lags, spots = [step[step >= least]], [first[step >= least]]
    ahead = 1
    while ahead < len(first):
        c = np.flatnonzero((key[ahead:] == key[:-ahead]) & (first[ahead:] - last[:-ahead] < 2 * k))
        if not len(c):
            break
        d = c + ahead
        lags += [first[d] - first[c], last[d] - last[c]]
        spots += [first[c], last[c]]
        p = np.maximum(step[c], step[d])
        for x in np.flatnonzero((p > 0) & (first[d] - last[c] - k <= 2 * p)).tolist():
            i, j, q = c[x], d[x], p[x]
            q = np.arange(first[j] - last[i], min(last[j] - first[i], 2 * k - 1) + 1, q)
            lags.append(q)
            spots.append(np.maximum(first[i], first[j] - q))
        ahead += 1
    lag, spot = np.concatenate(lags), np.concatenate(spots)
    good = (lag >= least) & (lag < 2 * k)
    return lag[good], spot[good]


def equal_stretch(words, a: int, b: int, limit: int, back: bool) -> int:
    """How many words from ``a`` and ``b`` on (back: before them) are equal."""
    import numpy as np

    n, size = 0, 32
    while n < limit:
        size = min(size, limit - n)
        if back:
            differ = words[a - n - size:a - n][::-1] != words[b - n - size:b - n][::-1]
        else:
            differ = words[a + n:a + n + size] != words[b + n:b + n + size]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, size = n + size, size * 4
    return n


def has_smaller_period(words, start: int, q: int) -> bool:
    """Whether the ``q`` words from ``start`` are themselves a repetition."""
    import numpy as np

    n, f, primes = q, 2, []
    while f * f <= n:
        if n % f == 0:
            primes.append(f)
            while n % f == 0:
                n //= f
        f += 1
    primes += [n] if n > 1 else []
    return any(np.array_equal(words[start:start + q - q // f], words[start + q // f:start + q]) for f in primes)


def find_runs(words, bounds: list[tuple[int, int]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start, then period.

    ``words``: word numbers of several documents laid together; ``bounds``: the
    stretch of each document in it."""
    import numpy as np

    found: list[list] = [[] for _ in bounds]
    sizes = np.array([hi - lo for lo, hi in bounds], np.int64)
    doc = np.repeat(np.arange(len(bounds)), sizes)
    end = np.repeat(np.array([hi for _, hi in bounds], np.int64), sizes)
    k, least = max(1, min_length // 2), 1
    if len(words) < k:
        return found
    own = mixed(words.astype(np.uint64) + np.uint64(1))
    keys = mixed(doc.astype(np.uint64) + np.uint64(1 << 40))[:len(words) - k + 1]
    for j in range(k):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + own[j:len(words) - k + 1 + j]
    places = np.arange(len(keys))
    inside = places + k <= end[:len(keys)]
    places, keys = places[inside], mixed(keys[inside])
    while len(places):
        live = repeated(keys)
        places, keys = places[live], keys[live]
        order = np.lexsort((places, keys))
        sorted_places, sorted_keys = places[order], keys[order]
        if len(places) > 1:
            lag, spot = chain_seeds(sorted_places, sorted_keys, k, least)
            order = np.lexsort((spot, lag))
            lag, spot = lag[order], spot[order]
            fresh = np.append(True, (lag[1:] != lag[:-1]) | (spot[1:] > spot[:-1] + 1)) if len(lag) else []
            covered, of_lag = -1, -1                     # furthest place covered on the present lag
            for q, i in zip(lag[fresh].tolist(), spot[fresh].tolist()):
                if q != of_lag:
                    covered, of_lag = -1, q
                if i < covered:
                    continue
                lo, hi = bounds[doc[i]]
                right = equal_stretch(words, i, i + q, hi - i - q, False)
                if not right:
                    continue                             # hashes clash, words do not agree
                s = i - equal_stretch(words, i, i + q, i - lo, True)
                covered = i + right
                if covered - s >= max(min_length - q, q) and not has_smaller_period(words, s, q):
                    found[doc[i]].append((s - lo, covered - s + q, q))
        at = np.full(len(words), -1, np.int64)
        at[places] = np.arange(len(places))
        both = np.flatnonzero(places + 2 * k <= end[places])
        both = both[at[places[both] + k] >= 0]
        keys = mixed(keys[both] * np.uint64(0x9E3779B97F4A7C15) + keys[at[places[both] + k]])
        places = places[both]
        k, least = 2 * k, 2 * k
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    import numpy as np

    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def run_finder(min_length: int, rewrite: Callable | None):
    """Rows (doc_id, text) to rows (doc_id, n_words, runs, collapsed)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                docs, numbers, parts, bounds, at = [], {}, [], [], 0
                for doc_id, text in zip(ids.slice(lo, hi - lo).to_pylist(), texts[lo:hi]):
                    words = text.encode().split() if text else []
                    order = rewrite(doc_id, len(words)) if rewrite else None
                    if order is not None:
                        words = [words[i] for i in order.tolist()]
                    parts.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, len(words)))
                    docs.append(words)
                    bounds.append((at, at + len(words)))
                    at += len(words)
                found = find_runs(np.concatenate(parts), bounds, min_length)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([len(w) for w in docs], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], kind),
                     pa.array([b" ".join(collapse(w, runs)) for w, runs in zip(docs, found)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  rewrite: Callable | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, ``runs`` (start, length, period;
    by start, then period) and the ``collapsed`` text, words joined by blanks.

    ``rewrite`` (id, number of words) may give positions to read the words from."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run_finder(min_length, rewrite), f"doc_id {kind}, n_words long, "
                     "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest_run(runs: Column) -> Column:
    """Struct (start, length, period) of the longest run; of equals the one that
    starts first, then of the smallest period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    return F.when(best.isNotNull(), F.struct((-best["before"]).alias("start"), best["length"].alias("length"),
                                             (-best["shorter"]).alias("period")))


def run_digest(runs: Column) -> Column:
    """SHA-256 over one line ``start,length,period`` per run."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
