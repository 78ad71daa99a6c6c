"""Language identification with a linear-chain CRF (operator 4).

Every word gets a label; the label sequence is scored by word features
(character 1- to 3-grams, affixes of three and four letters, a per-language
lexicon) and learned label transitions, so code-switched text is labelled run
by run. Training and prediction use forward-backward; a document's language is
the one with the largest mean word marginal.

A chain is a run of at most ``CHAIN`` consecutive words, as a sentence would
be; every word of a text is in exactly one chain. All chains of a batch are
worked on at once, step by step, in numpy.

The model (weights of hashed features, transitions, lexicons) has a fixed
maximal size and is fitted on the driver from a bounded sample of labelled
rows (``common.draw``, ``per_language`` texts of each language);
code-switched training chains are spliced from texts of different languages.

Defined results: a null text or one without a letter gets ``und`` with score
0; with no labelled rows at all every document gets ``und``; null ids and
repeated rows are scored like any other row; other columns are not read.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater._shipping import by_value
from tidewater.llm.common import WordTable, at_most, draw, flatten, fold, map_arrow, slices, training_texts, worker_cache

by_value(__name__)

BUCKETS = 1 << 16
CHAIN = 64
PER_LANGUAGE = 120
LEXICON = 3000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def word_features(words: list[str], lexicon: dict[str, int]):
    """Hashed feature numbers of all words as one flat array, with the start of
    each word's part. Words are laid end to end with a border character, so
    n-grams next to a border are the affixes of two letters and less."""
    import numpy as np

    flat = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(np.uint64)
    border = flat == 0
    word_at = np.cumsum(border) - 1                      # a border belongs to the word after it
    n = len(flat)
    mix = np.uint64(0x9E3779B97F4A7C15)
    feats, owner = [], []

    def add(hashes, owners, kind):
        feats.append((((hashes + np.uint64(kind)) * mix) >> np.uint64(40)) % np.uint64(BUCKETS))
        owner.append(owners)

    one = ~border
    add(flat[one], word_at[one], 1)
    two = flat[:-1] * np.uint64(0x10001) + flat[1:]
    ok = ~(border[:-1] & border[1:])
    add(two[ok], np.where(border[:-1], word_at[:-1], word_at[:-1])[ok], 2)
    three = two[:-1] * np.uint64(0x1000003) + flat[2:]
    ok = ~border[1:-1]
    add(three[ok], word_at[1:-1][ok], 3)
    start = np.flatnonzero(border)[:-1]
    length = np.diff(np.flatnonzero(border)) - 1
    for k in (3, 4):                                     # prefix and suffix of k letters
        own = np.flatnonzero(length >= k)
        head = np.zeros(len(own), np.uint64)
        tail = np.zeros(len(own), np.uint64)
        for j in range(k):
            head = head * np.uint64(0x1000193) + flat[start[own] + 1 + j]
            tail = tail * np.uint64(0x1000193) + flat[start[own] + length[own] - k + 1 + j]
        add(head, own, 10 + k)
        add(tail, own, 20 + k)
    sets = np.fromiter((lexicon.get(w, 0) for w in words), np.int64, len(words))
    known = np.flatnonzero(sets)
    feats.append((BUCKETS + sets[known]).astype(np.uint64))
    owner.append(known)
    feats, owner = np.concatenate(feats).astype(np.int64), np.concatenate(owner)
    by = np.argsort(owner, kind="stable")
    return feats[by], np.searchsorted(owner[by], np.arange(len(words)))


def emissions(feats, starts, weights):
    import numpy as np

    if not len(starts):
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[feats], starts, axis=0)


def forward_backward(scores, valid, trans, start):
    """Word marginals of all chains (chains x steps x labels) and the expected
    transition counts (training). ``valid`` marks real words."""
    import numpy as np

    n, steps, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    t = np.exp(trans)
    alpha = np.empty_like(e)
    a = e[:, 0] * np.exp(start)
    alpha[:, 0] = a / a.sum(1, keepdims=True)
    for i in range(1, steps):
        a = (alpha[:, i - 1] @ t) * e[:, i]
        alpha[:, i] = a / a.sum(1, keepdims=True)
    beta = np.ones((n, k), e.dtype)
    post = np.empty_like(e)
    pairs = np.zeros((k, k))
    for i in range(steps - 1, -1, -1):
        p = alpha[:, i] * beta
        post[:, i] = p / p.sum(1, keepdims=True)
        if i:
            right = e[:, i] * beta
            live = valid[:, i]
            joint = alpha[:, i - 1][:, :, None] * t[None] * right[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            pairs += joint[live].sum(0)
            b = right @ t.T
            beta = np.where(live[:, None], b / b.sum(1, keepdims=True), np.ones_like(b))
    return post, pairs


def marginals(scores, valid, trans, start):
    """Word marginals of chains laid out as (steps x chains x labels)."""
    import numpy as np

    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    t = np.exp(trans).astype(e.dtype)
    k = e.shape[2]
    ones = np.ones((k, k), e.dtype)                      # x @ ones: the row sums, k times
    a = e[0] * np.exp(start).astype(e.dtype)
    e_t, alpha = t.T.copy(), np.empty_like(e)
    alpha[0] = a / (a @ ones)
    for i in range(1, len(e)):
        a = (alpha[i - 1] @ t) * e[i]
        alpha[i] = a / (a @ ones)
    beta = np.ones_like(a)
    for i in range(len(e) - 1, -1, -1):
        if i:
            b = (e[i] * beta) @ e_t
        p = alpha[i] * beta
        alpha[i] = p / (p @ ones)
        if i:
            beta = b / (b @ ones)
            dead = ~valid[i]
            if dead.any():
                beta[dead] = 1
    return alpha


def chains(lengths, chain: int):
    """Word positions laid out as (chains x chain): index into the flat words,
    validity, and the document of each chain."""
    import numpy as np

    per = -(-lengths // chain)
    doc = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(lengths) - lengths)[doc] + nth * chain
    size = np.minimum(chain, lengths[doc] - nth * chain)
    step = np.arange(chain)
    valid = step[None] < size[:, None]
    return np.where(valid, first[:, None] + step[None], 0), valid, doc


def fit(rows: list, epochs: int = 20, seed: int = 7) -> dict:
    """Fit on (text, language) rows by full-batch gradient ascent (Adagrad) on
    the chain log-likelihood."""
    import numpy as np

    langs = sorted({r[1] for r in rows})
    if not langs:
        return {"langs": []}
    rng = np.random.default_rng(seed)
    index = {x: i for i, x in enumerate(langs)}
    docs = [(words_of(r[0]), index[r[1]]) for r in rows]
    counts: list[dict] = [{} for _ in langs]
    for ws, y in docs:
        for w in ws:
            counts[y][w] = counts[y].get(w, 0) + 1
    lexicon: dict[str, int] = {}
    for y, c in enumerate(counts):                       # a word's lexicon feature: the set of languages listing it
        for w in sorted(c, key=lambda w: (-c[w], w))[:LEXICON]:
            if c[w] > 1:
                lexicon[w] = lexicon.get(w, 0) | 1 << (y % 10)
    seqs = []
    for ws, y in docs:
        seqs += [(ws[i:i + CHAIN], [y] * len(ws[i:i + CHAIN])) for i in range(0, len(ws), CHAIN)]
    pure = [s for s in seqs if len(s[0]) >= 8]
    for _ in range(len(pure) // 3 if len(langs) > 1 else 0):   # spliced code-switched chains
        ws, ys = [], []
        while len(ws) < CHAIN:
            w, y = pure[rng.integers(len(pure))]
            k = int(rng.integers(4, 25))
            i = int(rng.integers(0, max(1, len(w) - k)))
            ws, ys = ws + w[i:i + k], ys + y[i:i + k]
        seqs.append((ws[:CHAIN], ys[:CHAIN]))
    codes: dict[str, int] = {}
    lengths = np.array([len(s[0]) for s in seqs], np.int64)
    flat = np.array([codes.setdefault(w, len(codes)) for s in seqs for w in s[0]], np.int64)
    gold = np.array([y for s in seqs for y in s[1]], np.int64)
    if not len(flat):
        return {"langs": []}
    lengths = lengths[lengths > 0]
    at, valid, _ = chains(lengths, CHAIN)
    feats, starts = word_features(list(codes), lexicon)
    per_word = np.diff(np.append(starts, len(feats)))
    k, size = len(langs), BUCKETS + (1 << 10)
    w = np.zeros((size, k), np.float64)
    trans, start = np.zeros((k, k)), np.zeros(k)
    gw, gt = np.full((size, k), 1e-3), np.full((k, k), 1e-3)
    onehot = np.eye(k)[gold[at]] * valid[:, :, None]
    seen = np.zeros((k, k))
    both = valid[:, 1:]
    np.add.at(seen, (gold[at[:, :-1]][both], gold[at[:, 1:]][both]), 1)
    total = valid.sum()
    for _ in range(epochs):
        scores = emissions(feats, starts, w)[flat][at]
        post, pairs = forward_backward(scores, valid, trans, start)
        diff = ((onehot - post) * valid[:, :, None])[valid]
        order = flat[at][valid]
        per_code = np.stack([np.bincount(order, diff[:, j], len(codes)) for j in range(k)], 1)
        spread = np.repeat(per_code, per_word, axis=0)
        grad = np.stack([np.bincount(feats, spread[:, j], size) for j in range(k)], 1) / total - 1e-7 * w
        gw += grad ** 2 * 1e6
        w += 0.3 * grad * 1e3 / np.sqrt(gw)
        tg = (seen - pairs) / total
        gt += tg ** 2 * 1e6
        trans += 0.3 * tg * 1e3 / np.sqrt(gt)
    return {"key": uuid.uuid4().hex, "langs": langs, "weights": w.astype(np.float32), "trans": trans.astype(np.float32),
            "start": start.astype(np.float32), "lexicon": lexicon}


def word_table(model: dict) -> WordTable:
    """Per distinct word: label scores and, last, 1 if it has a letter."""
    import numpy as np

    def rows_of(words):
        scores = emissions(*word_features(words, model["lexicon"]), model["weights"])
        letters = np.fromiter((any(map(str.isalpha, w)) for w in words), np.float32, len(words))
        return np.hstack([scores * letters[:, None], letters[:, None]])      # numerals and the like say nothing

    return WordTable(rows_of, 100_000)


def label_mass(texts: list, model: dict):
    """Per text: word count and summed word marginals per language."""
    import numpy as np

    k = len(model["langs"])
    cache = worker_cache("language")
    if cache.get("key") != model["key"]:
        cache["key"], cache["table"] = model["key"], word_table(model)
    known = cache["table"]
    mass, counts = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
    for lo, hi in slices(texts):
        docs = [words_of(t) for t in texts[lo:hi]]
        lengths = np.array([len(d) for d in docs], np.int64)
        if not lengths.sum():
            continue
        flat = known.lookup(flatten(docs))
        at, valid, doc = chains(lengths, CHAIN)
        for i in range(0, len(at), 4096):
            a, v = at[i:i + 4096], valid[i:i + 4096]
            rows = known.rows[flat[a.T]]                 # steps x chains x (labels, letter)
            use = (rows[:, :, k] * v.T)
            post = marginals(rows[:, :, :k], v.T, model["trans"], model["start"])
            first = np.flatnonzero(np.append(True, np.diff(doc[i:i + 4096]) > 0))
            own = lo + doc[i:i + 4096][first]
            mass[own] += np.add.reduceat((post * use[:, :, None]).sum(0, dtype=np.float64), first, axis=0)
            counts[own] += np.add.reduceat(use.sum(0).astype(np.int64), first)
    return mass, counts


def predictor(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if model["langs"]:
                mass, counts = label_mass(texts, model)
                best = mass.argmax(1)
                known = counts > 0
                score = np.where(known, mass.max(1) / np.maximum(counts, 1), 0.0).clip(0, 1)
                pred = [model["langs"][b] if ok else "und" for b, ok in zip(best, known)]
            else:
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return run


def train_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                         per_language: int = PER_LANGUAGE) -> dict:
    """Fit on the rows outside fold 0 of 5 (see ``common.fold``)."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"), F.col(id_col).alias("id"))
    rows = rows.filter(fold(F.col("id"), 5) != 0)
    drawn = training_texts(rows.filter(draw(rows, "label", "id", per_language)), "text")
    sample = at_most(drawn, "label", per_language, "id", "text").select("text", "label").collect()
    return fit(sorted(sample, key=lambda r: (str(r[1]), r[0])))


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # hashed weights and capped lexicons: a fixed size
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, predictor(shared), f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The input's rows and columns without those whose language is ``und`` or
    whose score is under ``least``; decided row by row, with no shuffle. Text
    switched between two languages scores about a half or more and stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            mass, counts = label_mass(batch.column(at).to_pylist(), shared.value)
            yield batch.filter(pa.array((counts > 0) & (mass.max(1) >= least * counts)))

    return map_arrow(docs, run, docs.schema) if model["langs"] else docs.limit(0)
