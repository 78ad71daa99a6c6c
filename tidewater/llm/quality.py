"""Quality classifier: histogram gradient-boosted trees (operator 9).

Each text becomes a row of statistics (``FEATURES``) over its bytes, words and
lines. Training sees feature quantile bins: a tree is grown level by level, the
best split of every node comes from gradient and Hessian histograms over the
bins, and leaves take Newton steps of the logistic loss. Finished trees are
complete binary trees flattened into arrays (feature, threshold, leaf value),
and a batch is scored by walking all rows down all trees level by level in
numpy.

Statistics of the labelled rows are computed by Spark tasks; only the feature
rows of a bounded sample (``PER_CLASS`` rows of each class) reach the driver.

Defined results: null and empty texts have all-zero statistics and a score like
any other row; without labelled rows of both classes every score is 0.5; null
ids and repeated rows are scored like any other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import at_most, draw, fold, map_arrow

by_value(__name__)

FEATURES = (
    "log_bytes", "upper", "lower", "digit", "blank", "stop", "comma", "mark", "quote", "bar", "other", "high",
    "control", "log_words", "word_length", "distinct", "top_word", "short_words", "long_words", "longest_word",
    "capital_words", "log_lines", "distinct_lines", "line_words", "mark_words", "repeat_pairs",
)
PER_CLASS = 3000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2


def byte_classes():
    """Class of every byte value, as an array."""
    import numpy as np

    kinds = np.full(256, 8, np.int64)                    # other symbols
    for chars, k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0), (b"abcdefghijklmnopqrstuvwxyz", 1), (b"0123456789", 2),
                     (b" \t\n\r\x0b\x0c", 3), (b".", 4), (b",;:", 5), (b"!?", 6), (b"\"'()-", 7), (b"|#*$%&@<>=_{}[]\\/~^+", 9)):
        kinds[list(chars)] = k
    kinds[128:] = 10
    kinds[[i for i in range(32) if i not in b"\t\n\r\x0b\x0c"] + [127]] = 11
    return kinds


def statistics(text: str | None, kinds) -> list[float]:
    import numpy as np

    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    n = len(raw)
    share = np.bincount(kinds[raw], minlength=12) / n
    words = text.split()
    k = max(1, len(words))
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    marked = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,")
    capital = sum(c for w, c in counts.items() if w.isupper() and len(w) > 1)
    return [np.log1p(n), share[0], share[1], share[2], share[3], share[4], share[5], share[6], share[7], share[9],
            share[8], share[10], share[11], np.log1p(len(words)), sizes.mean() if len(words) else 0.0,
            len(counts) / k, max(counts.values(), default=0) / k, (sizes <= 2).sum() / k, (sizes >= 15).sum() / k,
            float(sizes.max(initial=0)), capital / k, np.log1p(len(lines)),
            len(set(lines)) / max(1, len(lines)), k / max(1, len(lines)), marked / k, 1 - pairs / max(1, len(words) - 1)]


def matrix(texts: list):
    import numpy as np

    kinds = byte_classes()
    return np.array([statistics(t, kinds) for t in texts], np.float64).reshape(-1, len(FEATURES))


def fit(x, y, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, l2: float = 1.0) -> dict:
    """Boosted trees on feature rows ``x`` and 0/1 labels ``y``."""
    import numpy as np

    if not (0 < y.sum() < len(y)):
        return {}
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    base = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)                # node number inside its level
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                cell = node * BINS + binned[:, f]
                gs = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt ** 2 / (ht + l2)
                gain[(hs < 1) | (ht - hs < 1)] = 0
                gain = gain[:, :len(e)]
                if not gain.size:
                    continue
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                win = top > best
                best[win] = top[win]
                feature[t, first:first + width][win] = f
                threshold[t, first:first + width][win] = e[at[win]]
            own = first + node
            node = node * 2 + (x[np.arange(len(y)), feature[t, own]] > threshold[t, own])
        gl, hl = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value[t] = -rate * gl / (hl + l2)
        z += value[t][node]
    return {"base": base, "depth": depth, "feature": feature, "threshold": threshold, "value": value}


def predict(x, model: dict):
    """Probability per row: all rows walk down all trees, level by level."""
    import numpy as np

    if not model:
        return np.full(len(x), 0.5)
    n, trees = len(x), len(model["value"])
    tree, row = np.arange(trees)[None, :], np.arange(n)[:, None]
    node = np.zeros((n, trees), np.int64)
    for level in range(model["depth"]):
        own = (1 << level) - 1 + node
        node = node * 2 + (x[row, model["feature"][tree, own]] > model["threshold"][tree, own])
    z = model["base"] + model["value"][tree, node].sum(1)
    return 1 / (1 + np.exp(-z))


def describe(batches):
    import pyarrow as pa

    for batch in batches:
        x = matrix(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])


def train_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        label_col: str = "quality", per_class: int = PER_CLASS) -> dict:
    """Fit on labelled rows outside fold 1 of 3."""
    import numpy as np

    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(fold(F.col("id"), 3) != 1).distinct()
    given = F.broadcast(given.filter(draw(given, "label", "id", per_class)))       # about 2 x per_class rows
    rows = at_most(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(given, "id"), "label", per_class, "id", "text")
    got = map_arrow(rows.select("text", F.col("label").cast("int").alias("label")), describe,
                    "x array<double>, label int").collect()
    got.sort(key=lambda r: (r[1], r[0]))
    return fit(np.array([r[0] for r in got]).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], np.float64))


def scorer(shared):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            s = [predict(matrix(texts[i:i + 2048]), shared.value) for i in range(0, len(texts), 2048)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([float(v) for a in s for v in a], pa.float64())],
                                             names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # TREES x 2^DEPTH numbers
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, scorer(shared), f"doc_id {kind}, score double")
