"""Toxicity by a convolutional text classifier (operator 3).

Every word is the mean of four hashed embeddings: the word itself and its first
four, five and six letters, so unseen inflections share what was learned. Filter
banks of several widths slide over the whole text, each filter's ReLU maximum is
kept, and a logistic layer gives the score. Training (Adagrad, gradients through
the maxima) and scoring are numpy.

Filters are applied through tables: a distinct word's embedding is multiplied
once with every filter position, and a window's response is a sum of looked-up
rows. A text of any length is scored whole, in windows of bounded memory.

Every labelled row outside the held-out fold counts. The log odds that start the
embeddings are counts over all of them, added up by Spark. Training runs in rounds:
each task takes the shared model through its part of the rows in small batches, and
Spark averages what the tasks changed, row by row over the tasks that touched it, in
whole numbers, so the order of tasks does not matter. The number of tasks is bounded
(``MAX_TASKS``), so what is exchanged a round is a fixed number of model sizes and
only one averaged model reaches the driver. Per-language thresholds are calibrated
on the fifth of the rows that is not trained on, all of it: the smallest threshold
(to six decimals) whose false positive rate is at most ``MAX_FALSE``; a language
with too few negatives takes the overall one. Language chooses only the threshold,
never the score.

Defined results: null and empty texts score like a text without words; without
labelled rows of both classes every score is 0; null languages take the overall
threshold; null ids and repeated rows are scored like any other; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import WordTable, at_most, cut, flatten, fold, map_arrow, parted, slices, worker_cache

by_value(__name__)

BUCKETS = 1 << 17
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
MAX_FALSE = 0.01
EPOCHS = 2
STEPS = 200
BATCH = 32
ROWS_A_TASK = 2000
MAX_TASKS = 64
SCALE = 1 << 24                                          # averaged numbers are added as multiples of 1 / SCALE
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def buckets_of(words: list[str]):
    """(words x 4) hashed bucket numbers: word and its first 4, 5, 6 letters."""
    import zlib

    import numpy as np

    crc = zlib.crc32
    rows = [(crc(b), crc(w[:4].encode(), 4), crc(w[:5].encode(), 5), crc(w[:6].encode(), 6))
            for w in words for b in (w.encode(),)]
    return (np.array(rows, np.int64).reshape(-1, 4) * 0x9E3779B1 >> 7) % BUCKETS


def layout(docs: list[list[str]]):
    """Flat word codes of several texts, each followed by pads (code 0) so that
    no window spans two texts; distinct words; start of each text."""
    import numpy as np

    codes: dict[str, int] = {"": 0}
    flat: list[int] = []
    starts = []
    for ws in docs:
        starts.append(len(flat))
        flat += [codes.setdefault(w, len(codes)) for w in ws]
        flat += [0] * max(WIDTHS)
    return np.array(flat, np.int64), list(codes), np.array(starts, np.int64)


def responses(flat, embedded, filters):
    """(positions x FILTERS) response of each width; windows that begin in the
    padding are minus infinity."""
    import numpy as np

    out = []
    for width, bank in zip(WIDTHS, filters):
        c = np.full((len(flat), FILTERS), -np.inf, np.float32)
        n = len(flat) - width + 1
        if n > 0:
            acc = (embedded @ bank[0])[flat[:n]]
            for j in range(1, width):
                acc += (embedded @ bank[j])[flat[j:j + n]]
            c[:n] = acc
        c[flat == 0] = -np.inf
        out.append(c)
    return out


def table_rows(words: list[str], table):
    """Embeddings of words: the mean of their four bucket rows."""
    rows = buckets_of(words)
    e = table[rows[:, 0]]
    for j in range(1, 4):
        e += table[rows[:, j]]
    return e / 4


def word_table(model: dict) -> WordTable:
    """Per distinct word: its embedding times every position of every filter."""
    import numpy as np

    bank = np.concatenate([f.transpose(1, 0, 2).reshape(DIM, -1) for f in model["filters"]], 1)

    def rows_of(words):
        rows = table_rows(words, model["table"]) @ bank
        rows[[not w for w in words]] = 0                 # the pad
        return rows

    return WordTable(rows_of, 100_000)


def score(texts: list, model: dict):
    """Probabilities; filters are applied by summing looked-up rows."""
    import numpy as np

    out = np.zeros(len(texts))
    if not model:
        return out
    cache = worker_cache("toxicity")
    if cache.get("key") != model["key"]:
        cache["key"], cache["table"] = model["key"], word_table(model)
    known = cache["table"]
    pad = [""] * max(WIDTHS)
    for lo, hi in slices(texts, 1_000_000):
        docs = [words_of(t) + pad for t in texts[lo:hi]]
        sizes = np.array([len(d) for d in docs], np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = known.lookup(flatten(docs))
        empty = known.codes[""]
        inside = np.flatnonzero(flat != empty)           # windows that begin in the text
        top = []
        column = 0
        for width, b in zip(WIDTHS, model["bias"]):
            c = np.full((len(flat), FILTERS), -np.inf, np.float32)
            acc = known.rows[flat[inside], column:column + FILTERS]
            for j in range(1, width):
                column += FILTERS
                acc += known.rows[flat[inside + j], column:column + FILTERS]
            column += FILTERS
            c[inside] = acc
            top.append(np.maximum(np.maximum.reduceat(c, starts, axis=0) + b, 0))
        z = np.concatenate(top, 1) @ model["out"] + model["shift"]
        out[lo:hi] = 1 / (1 + np.exp(-z.clip(-30, 30)))
    return out


def odds_of(seen, n):
    """Start of the first embedding dimension: how much oftener a bucket's words
    stand in texts of class 1, shrunk when they are rare."""
    import numpy as np

    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    return (odds * np.minimum(1, seen.sum(0) / 6)).clip(-2, 2)


def count_buckets(docs: list[list[str]], y, seen) -> None:
    """Add the texts of each class that hold a bucket."""
    import numpy as np

    for words, label in zip(docs, y):
        seen[int(label), np.unique(buckets_of(sorted(set(words))))] += 1


def initial(odds, seed: int) -> dict:
    import numpy as np

    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    table[:, 0] = odds
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0] += np.linspace(1, 0.25, FILTERS, dtype=np.float32) / len(f)
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out, shift = np.full(FILTERS * len(WIDTHS), 0.2, np.float32), np.full(1, -1, np.float32)
    return {"table": table, "dense": [*filters, *bias, out, shift], "table_squares": np.full((BUCKETS, DIM), 1e-2, np.float32),
            "dense_squares": [np.full_like(x, 1e-2) for x in [*filters, *bias, out, shift]]}


def peaks(flat, starts, e, filters, block: int = 1 << 18):
    """Per width, place and value of every filter's largest response in each text
    (docs x FILTERS); memory is bounded by ``block`` places, not by the text."""
    import numpy as np

    stops = np.append(starts[1:], len(flat))
    best = [np.repeat(starts[:, None], FILTERS, 1) for _ in WIDTHS]
    top = [np.full((len(starts), FILTERS), -np.inf, np.float32) for _ in WIDTHS]
    for lo in range(0, len(flat), block):
        hi = min(lo + block, len(flat))
        c = responses(flat[lo:hi + max(WIDTHS) - 1], e, filters)
        for d in range(np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi, "left")):
            s, t = max(starts[d], lo), min(stops[d], hi)
            for x, b, v in zip(c, best, top):
                own = x[s - lo:t - lo]
                at = own.argmax(0)
                value = own[at, np.arange(FILTERS)]
                more = value > v[d]
                v[d][more], b[d][more] = value[more], (s + at)[more]
    return best, top


def step(state: dict, docs: list[list[str]], y, weight, lr: float = 0.1):
    """One Adagrad step on a batch, in place; returns the table rows it changed."""
    import numpy as np

    table, squares, k = state["table"], state["table_squares"], len(WIDTHS)
    filters, bias, (out, shift) = state["dense"][:k], state["dense"][k:2 * k], state["dense"][2 * k:]
    flat, words, starts = layout(docs)
    hashed = buckets_of(words)
    e = table[hashed].mean(1).astype(np.float32)
    e[0] = 0
    best, top = peaks(flat, starts, e, filters)
    hidden = np.concatenate([np.maximum(t + v, 0) for t, v in zip(top, bias)], 1)
    p = 1 / (1 + np.exp(-(hidden @ out + shift[0]).clip(-30, 30)))
    g = ((p - y) * weight / len(docs)).astype(np.float32)
    g_out, g_shift = hidden.T @ g + 1e-5 * out, g.sum(keepdims=True)
    g_hidden = (g[:, None] * out[None]) * (hidden > 0)
    rows, grads, g_filters, g_bias = [], [], [], []
    for i, (w, b) in enumerate(zip(WIDTHS, best)):
        gh = g_hidden[:, i * FILTERS:(i + 1) * FILTERS]
        g_bias.append(gh.sum(0))
        gf = np.zeros_like(filters[i])
        for j in range(w):
            code = flat[np.minimum(b + j, len(flat) - 1)]             # docs x FILTERS
            gf[j] = np.einsum("dfe,df->ef", e[code], gh)
            use = (gh != 0) & (code != 0)
            ge = gh[:, :, None] * filters[i][j].T[None]                # docs x FILTERS x DIM
            rows.append(hashed[code[use]].ravel())
            grads.append(np.repeat(ge[use] / 4, 4, axis=0))
        g_filters.append(gf)
    unique, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    if len(unique):
        total = np.zeros((len(unique), DIM), np.float32)
        np.add.at(total, inverse, np.concatenate(grads))
        squares[unique] += total ** 2 * 100
        table[unique] -= lr * total * 10 / np.sqrt(squares[unique])
    for x, q, gx in zip(state["dense"], state["dense_squares"], [*g_filters, *g_bias, g_out, g_shift]):
        q += gx ** 2
        x -= lr * gx / np.sqrt(q)
    return unique


def passes(n: int) -> int:
    """Times that ``n`` rows are gone through: small tables get ``STEPS`` steps."""
    return max(EPOCHS, -(-STEPS * BATCH // n))


def finished(state: dict) -> dict:
    k = len(WIDTHS)
    dense = state["dense"]
    return {"key": uuid.uuid4().hex, "table": state["table"], "filters": dense[:k], "bias": dense[k:2 * k], "out": dense[2 * k],
            "shift": float(dense[2 * k + 1][0])}


def class_weights(n):
    """Both classes count the same."""
    return [0.5 * sum(n) / n[0], 0.5 * sum(n) / n[1]]


def fit(texts: list, labels: list, epochs: int = EPOCHS, seed: int = 11, batch: int = BATCH) -> dict:
    """The same training on rows at hand, in one place."""
    import numpy as np

    y = np.array(labels, np.float64)
    if not (0 < y.sum() < len(y)):
        return {}
    rng = np.random.default_rng(seed)
    docs = [words_of(t) for t in texts]
    seen, n = np.zeros((2, BUCKETS)), [int((y == 0).sum()), int((y == 1).sum())]
    count_buckets(docs, y, seen)
    state, weight = initial(odds_of(seen, n), seed), np.array(class_weights(n))[y.astype(int)]
    for _ in range(max(epochs, passes(len(docs)))):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            step(state, [docs[i] for i in pick], y[pick], weight[pick])
    return finished(state)


def batches_of(rows, most: int = BATCH, chars: int = 1_000_000):
    """(words, labels) of rows (text, label) as they come, few at a time: at most
    ``most`` texts of together ``chars`` characters (a longer one stands alone)."""
    docs, y, n = [], [], 0
    for text, label in rows:
        if docs and (len(docs) >= most or n + len(text or "") > chars):
            yield docs, y
            docs, y, n = [], [], 0
        docs.append(words_of(text))
        y.append(label)
        n += len(text or "")
    if docs:
        yield docs, y


def _rows(batches):
    for b in batches:
        yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist())


def bucket_counter():
    def run(batches):
        import numpy as np
        import pyarrow as pa

        seen = np.zeros((2, BUCKETS))
        for docs, y in batches_of(_rows(batches)):
            count_buckets(docs, y, seen)
        label, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"label": pa.array(label, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
                                          "n": pa.array(seen[label, bucket].astype(np.int64), pa.int64())})

    return run


def _dense_rows(arrays):
    """Small parameters as rows as wide as the table's."""
    import numpy as np

    flat = np.concatenate([x.ravel() for x in arrays]).astype(np.float64)
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def trainer(shared, times: int):
    """Takes the shared state through a task's rows ``times`` times; returns the
    changed rows of the parameters, less what they were, as whole numbers."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        start, weights = shared.value["state"], np.array(shared.value["weights"])
        state = {k: [x.copy() for x in v] if isinstance(v, list) else v.copy() for k, v in start.items()}
        touched, some = np.zeros(BUCKETS, bool), False
        rows = _rows(batches) if times == 1 else list(_rows(batches))     # several times only for small tables
        rng = np.random.default_rng(11)
        for _ in range(times):
            for docs, y in batches_of(rows if times == 1 else [rows[i] for i in rng.permutation(len(rows))]):
                y, some = np.array(y, np.float64), True
                touched[step(state, docs, y, weights[y.astype(int)])] = True
        if not some:
            return
        own = np.flatnonzero(touched)
        change = np.concatenate([state["table"][own].astype(np.float64) - start["table"][own],
                                 _dense_rows(state["dense"]) - _dense_rows(start["dense"])])
        square = np.concatenate([state["table_squares"][own].astype(np.float64) - start["table_squares"][own],
                                 _dense_rows(state["dense_squares"]) - _dense_rows(start["dense_squares"])])
        at = np.concatenate([own, BUCKETS + np.arange(len(change) - len(own))])
        whole = np.rint(np.concatenate([change, square], 1) * SCALE).astype(np.int64)
        for lo in range(0, len(at), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[lo:lo + 20_000], pa.int32()), *[pa.array(c) for c in whole[lo:lo + 20_000].T]],
                                             names=["row", *[f"v{i}" for i in range(2 * DIM)]])

    return run


def merge(state: dict, got) -> dict:
    """The state after a round; ``got``: row, number of tasks and sums of changes."""
    import numpy as np

    at = got.column("row").to_numpy()
    mean = np.stack([got.column(f"v{i}").to_numpy() for i in range(2 * DIM)], 1) / SCALE / got.column("n").to_numpy()[:, None]
    new, wide = dict(state), at < BUCKETS
    for name, part in (("table", mean[:, :DIM]), ("table_squares", mean[:, DIM:])):
        new[name] = state[name].copy()
        new[name][at[wide]] += part[wide].astype(np.float32)
    for name, part in (("dense", mean[:, :DIM]), ("dense_squares", mean[:, DIM:])):
        flat = np.zeros(_dense_rows(state[name]).shape)
        flat[at[~wide] - BUCKETS] = part[~wide]
        flat, done, new[name] = flat.ravel(), 0, []
        for x in state[name]:
            new[name].append((x + flat[done:done + x.size].reshape(x.shape)).astype(np.float32))
            done += x.size
    return new


def fit_rows(rows: DataFrame, n: list[int], seed: int = 11) -> dict:
    """The model of all ``rows`` (text, label 0 or 1), ``n`` of each class, in the
    partitions they have."""
    import numpy as np

    if not all(n):
        return {}
    context, pairs = rows.sparkSession.sparkContext, rows.select("text", "label")
    counted = (map_arrow(pairs, bucket_counter(), "label int, bucket int, n long").groupBy("label", "bucket")
               .agg(F.sum("n").alias("n")).toArrow())                       # at most 2 x BUCKETS rows
    seen = np.zeros((2, BUCKETS))
    seen[counted.column("label").to_numpy(), counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    state, rounds = initial(odds_of(seen, n), seed), passes(sum(n))
    small = sum(n) <= ROWS_A_TASK                                           # one task: all passes in one round
    fields = [f"v{i}" for i in range(2 * DIM)]
    for _ in range(1 if small else rounds):
        shared = context.broadcast({"state": state, "weights": class_weights(n)})      # fixed size
        got = (map_arrow(pairs, trainer(shared, rounds if small else 1), "row int, " + ", ".join(f"{f} long" for f in fields))
               .groupBy("row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in fields]).toArrow())
        state = merge(state, got)
        shared.unpersist()
    return finished(state)


def calibrate(scored: DataFrame, max_false: float = MAX_FALSE, least: int = 50) -> dict:
    """Threshold per language (None: overall) with at most ``max_false`` false
    positives among the negatives of ``scored`` (label, lang, score). Negatives are
    counted by their score in millionths, which bounds what a language's task orders."""
    clean = scored.filter(F.col("label") == 0).select("lang", F.ceil(F.col("score") * 1_000_000).alias("at"))
    every = clean.select(F.lit(True).alias("overall"), F.lit(None).cast("string").alias("lang"), "at").unionByName(
        clean.filter(F.col("lang").isNotNull()).select(F.lit(False).alias("overall"), "lang", "at"))
    counts = every.groupBy("overall", "lang", "at").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("overall", "lang")
    up = own.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"below": F.sum("n").over(up), "all": F.sum("n").over(own)})
    found = (ranked.filter((F.col("overall") | (F.col("all") >= least)) & (F.col("below") >= F.ceil(F.col("all") * (1 - max_false))))
             .groupBy("overall", "lang").agg(F.min("at").alias("at")).collect())         # a row per language
    out = {None: 0.5} | {r["lang"]: r["at"] / 1e6 for r in found}
    return {k: float(min(1.0, max(0.5, v + 1e-6 * (v > 0.5)))) for k, v in out.items()}


def labelled_scorer(shared):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = score(batch.column(0).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(s, pa.float64())], names=["label", "lang", "score"])

    return run


def mix(id_col: str, text_col: str):
    """Deals rows to tasks and orders them within: a hash of id and text."""
    return F.xxhash64(id_col, text_col, F.lit("mix"))


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, lang_col: str,
                  tasks: int | None = None) -> DataFrame:
    """(id, text, lang, label, _mix) of every labelled row outside fold 1 of 3, with
    ``tasks`` dealt to so many partitions by ``_mix``. The labels meet the ids and
    hashes of the rows first and go beside the texts to their partitions, so a text
    is shuffled once, and only if it may have a label."""
    i = F.col(id_col)
    given = (labels.filter(i.isNotNull() & F.col(label_col).isNotNull() & (fold(i, 3) != 1))
             .select(i.alias("id"), F.col(label_col).cast("int").alias("label")).distinct())
    rows = docs.filter(i.isNotNull()).select(i.alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    texts = parted(rows, "id", given)[1].withColumn("_mix", mix("id", "text"))
    known = texts.select("id", "_mix").distinct().join(given.groupBy("id").agg(F.collect_set("label").alias("_labels")), "id")
    both = texts.withColumn("_row", F.lit(True)).unionByName(known.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    both = both.repartition(tasks, "_mix") if tasks else both
    both = both.withColumn("_labels", F.max("_labels").over(Window.partitionBy("_mix", "id")))
    return both.filter("_row").select("id", "text", "lang", F.explode("_labels").alias("label"), "_mix")


def train_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "toxic", lang_col: str = "lang", per_class: int | None = None) -> dict:
    """Fit and calibrate on all labelled rows outside fold 1 of 3 (``per_class``: on
    that many of each class at most); a fifth of them only calibrates."""
    counted = labels.filter(F.col(label_col).isNotNull() & (fold(F.col(id_col), 3) != 1)).count()
    tasks = max(1, min(MAX_TASKS, -(-counted // ROWS_A_TASK)))
    rows = labelled_rows(docs, labels, id_col, text_col, label_col, lang_col, tasks if per_class is None else None)
    if per_class is not None:
        rows = at_most(rows, "label", per_class, "id", "text", "lang").repartition(tasks, "_mix")
    held = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 5 == 0
    rows = cut(rows.withColumn("held", held).sortWithinPartitions("_mix", "label", "lang").drop("_mix"))
    train = rows.filter(~F.col("held"))
    n = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    model = fit_rows(train, [n.get(0, 0), n.get(1, 0)])
    shared = rows.sparkSession.sparkContext.broadcast(model)
    scored = map_arrow(rows.filter("held").select("text", "label", "lang"), labelled_scorer(shared), "label int, lang string, score double")
    return {"model": model, "thresholds": calibrate(scored)}


def scorer(shared):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = score(batch.column(1).to_pylist(), shared.value["model"])
            own = shared.value["thresholds"]
            limit = [own.get(x, own.get(None, 0.5)) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array(limit, pa.float64())],
                                             names=["doc_id", "score", "lang_threshold"])

    return run


def toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, score, lang_threshold of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # fixed size: BUCKETS x DIM floats
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, scorer(shared), f"doc_id {kind}, score double, lang_threshold double")
