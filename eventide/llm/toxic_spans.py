"""Toxicity by a linear-chain conditional random field over words.

Only documents are labelled, so the words of a bounded sample of labelled
documents get their tags first: in a toxic document a word is tagged when one of
its features (the word, its first or last bytes) is found almost only in toxic
documents. A two-state chain is trained on these tags in numpy. Every text
is then tagged whole: forward-backward marginals give the probability of each
word, runs of likely words are the offending spans, and the strongest and the
expected number of toxic words give the document's score by a logistic
curve fitted on the same sample, without the toxic documents that hold no
tagged word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import map_arrow, table, text_column, utf8, word_bounds, word_hashes
from eventide.llm.weighted_minhash import slices

#: Bound of the labelled sample: documents of either label, and bytes of text.
SAMPLE_DOCS, SAMPLE_BYTES = 3000, 10 << 20
FEATURE_BITS = 18
BLOCK = 64
FOLDS, HELD_FOLD = 5, 0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?\"')]")] = True
_HEAD = np.zeros(256, bool)
_HEAD[list(b"\"'([")] = True


@dataclass
class Model:
    weights: np.ndarray      # emission log-odds of the toxic state per feature
    trans: np.ndarray        # 2 x 2 transition log weights
    bias: float
    curve: np.ndarray        # logistic curve of the document score


def word_features(data: np.ndarray, off: np.ndarray):
    """Hashed features of every word, ``(features, words)``, with the words'
    bounds and the number of words before each text."""
    starts, ends, before = word_bounds(data, off)
    low = _LOWER[data] if len(data) else data
    a, b = starts.copy(), ends.copy()
    for _ in range(2):
        if len(b):
            b -= _TAIL[low[b - 1]] & (b - a > 1)
            a += _HEAD[low[a]] & (b - a > 1)
    rows = [word_hashes(low, a, b, 1)]
    for k in (3, 4, 5, 6, 8):
        rows.append(word_hashes(low, a, np.minimum(b, a + k), 1 + k))
    for k in (3, 5):
        rows.append(word_hashes(low, np.maximum(a, b - k), b, 20 + k))
    index = np.stack([r >> np.uint64(64 - FEATURE_BITS) for r in rows]).astype(np.int32) if len(a) else np.empty((8, 0), np.int32)
    return index, starts, ends, before


def chain(emit: np.ndarray, before: np.ndarray, trans: np.ndarray):
    """Forward and backward messages of every word of many texts, and the
    one-step weights, for a two-state chain with emission log-odds ``emit``.

    Texts are cut into blocks of 64 words. Blocks are multiplied up side by side, their
    borders are chained per text, then the messages are filled in: the
    number of steps is 128 plus the blocks of the longest text."""
    n = np.diff(before)
    blocks = -(-n // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    total = int(first[-1])
    slot = np.arange(len(emit)) - np.repeat(before[:-1], n)
    at = (np.repeat(first[:-1], n) + slot // BLOCK) * BLOCK + slot % BLOCK
    live = np.zeros(total * BLOCK, bool)
    live[at] = True
    p1 = np.full(total * BLOCK, 0.5)
    p1[at] = 1 / (1 + np.exp(-np.clip(emit, -30, 30)))
    live, p1 = live.reshape(total, BLOCK), p1.reshape(total, BLOCK)
    step = np.exp(trans)
    # first words have no step from a word before: start weights are even
    start = np.zeros((total, BLOCK), bool)
    if total:
        start[first[:-1][n > 0], 0] = True

    def matrix(t):
        m = np.where(start[:, t, None, None], 1.0, step) * np.stack([1 - p1[:, t], p1[:, t]], 1)[:, None, :]
        return np.where(live[:, t, None, None], m, np.eye(2))

    whole = np.tile(np.eye(2), (total, 1, 1))
    for t in range(BLOCK):
        whole = whole @ matrix(t)
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.full((total, 2), 0.5), np.full((total, 2), 1.0)
    order = np.argsort(-blocks, kind="stable")
    sizes = blocks[order]
    for k in range(1, int(blocks.max(initial=0))):
        d = order[:np.searchsorted(-sizes, -k, "left")]
        i = first[d] + k
        v = np.einsum("ni,nij->nj", enter[i - 1], whole[i - 1])
        enter[i] = v / v.sum(axis=1, keepdims=True)
        j = first[d + 1] - 1 - k
        v = np.einsum("nij,nj->ni", whole[j + 1], leave[j + 1])
        leave[j] = v / v.sum(axis=1, keepdims=True)
    fore, back = np.empty((total, BLOCK, 2)), np.empty((total, BLOCK, 2))
    v = enter
    for t in range(BLOCK):
        v = np.einsum("ni,nij->nj", v, matrix(t))
        v = v / v.sum(axis=1, keepdims=True)
        fore[:, t] = v
    v = leave
    for t in range(BLOCK - 1, -1, -1):
        back[:, t] = v
        v = np.einsum("nij,nj->ni", matrix(t), v)
        v = v / v.sum(axis=1, keepdims=True)
    fore, back = fore.reshape(-1, 2)[at], back.reshape(-1, 2)[at]
    return fore, back, p1.reshape(-1)[at], slot == 0


def marginals(emit: np.ndarray, before: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at every word."""
    if not len(emit):
        return np.empty(0)
    fore, back, _, _ = chain(emit, before, trans)
    both = fore * back
    return both[:, 1] / both.sum(axis=1)


def tag_words(index: np.ndarray, before: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Tags of the sample's words: in a toxic text, a word with a feature that is
    found in at least 3 of the toxic texts and 1 in 250 of them, and 20 times
    more often among toxic than among other texts."""
    doc = np.repeat(np.arange(len(toxic)), np.diff(before))
    bad, good = np.zeros(1 << FEATURE_BITS, np.int64), np.zeros(1 << FEATURE_BITS, np.int64)
    for row in index:
        pairs = np.unique(doc * np.int64(1 << FEATURE_BITS) + row)
        feature, of = pairs & ((1 << FEATURE_BITS) - 1), toxic[pairs >> FEATURE_BITS]
        bad += np.bincount(feature[of], minlength=1 << FEATURE_BITS)
        good += np.bincount(feature[~of], minlength=1 << FEATURE_BITS)
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    sure = (bad >= max(3, toxic.sum() / 250)) & (odds >= np.log(20))
    return np.logical_or.reduce([sure[row] for row in index]) & toxic[doc]


def document_view(p: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Per text: log-odds of its strongest word, log of the expected number of
    toxic words, and 1."""
    n = np.diff(before)
    top, total = np.zeros(len(n)), np.zeros(len(n))
    if len(p):
        has = np.flatnonzero(n)
        top[has] = np.maximum.reduceat(p, before[:-1][has])
        total[has] = np.add.reduceat(p, before[:-1][has])
    top = np.clip(top, 1e-5, 1 - 1e-5)
    return np.stack([np.log(top / (1 - top)), np.log(total + 1e-3), np.ones(len(n))], 1)


def train(texts: list[str], toxic: np.ndarray, epochs: int = 6, seed: int = 3) -> Model:
    """Adam on the chain's log-likelihood over batches of texts of like
    length, then the document curve by Newton steps."""
    order = np.argsort([len(t) for t in texts], kind="stable")
    column = pa.array([texts[i] for i in order], pa.large_string())
    parts, before = [], [0]
    for a, b in slices(column, 1 << 20):
        part, _, _, cut = word_features(*utf8(column.slice(a, b - a)))
        parts.append(part)
        before += (cut[1:] + before[-1]).tolist()
    index, before, label = np.concatenate(parts, axis=1), np.array(before), toxic[order]
    del parts, column
    tags = tag_words(index, before, label)
    weights, trans, bias = np.zeros(1 << FEATURE_BITS), np.zeros((2, 2)), -2.0
    state = {k: [0.0, 0.0] for k in ("w", "t", "b")}
    cuts = np.unique(np.append(np.searchsorted(before, np.arange(0, before[-1], 60_000), "left"), len(label)))
    batches = [(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    rng, turn = np.random.default_rng(seed), 0

    def adam(name, value, grad, rate):
        m, v = state[name]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        state[name] = [m, v]
        return value + rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-6)

    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            a, b = batches[k]
            lo, hi = before[a], before[b]
            if hi == lo:
                continue
            turn += 1
            f, y, cut = index[:, lo:hi], tags[lo:hi], before[a:b + 1] - lo
            fore, back, p1, start = chain(weights[f].sum(axis=0) + bias, cut, trans)
            both = fore * back
            p = both[:, 1] / both.sum(axis=1)
            gap = y - p
            grad_w = np.bincount(f.ravel(), np.broadcast_to(gap, f.shape).ravel(), 1 << FEATURE_BITS) / (hi - lo) - 1e-7 * weights
            i = np.flatnonzero(~start)
            step = np.exp(trans)
            pair = fore[i - 1][:, :, None] * step[None] * (np.stack([1 - p1[i], p1[i]], 1) * back[i])[:, None, :]
            pair = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[i - 1].astype(int), y[i].astype(int)), 1)
            rate = 0.15 * (1 - epoch / epochs) + 0.01
            weights = adam("w", weights, grad_w, rate)
            trans = adam("t", trans, (seen - pair) / (hi - lo), rate)
            bias = adam("b", bias, gap.mean(), rate)
    p = np.concatenate([marginals(weights[index[:, before[a]:before[b]]].sum(axis=0) + bias, before[a:b + 1] - before[a], trans)
                        for a, b in batches]) if batches else np.empty(0)
    # a toxic label without any tagged word teaches the curve nothing about words
    told = ~label | (np.add.reduceat(np.append(tags, 0), before[:-1]) * (np.diff(before) > 0) > 0)
    x, curve, y = document_view(p, before)[told], np.zeros(3), label[told].astype(float)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(3)
        curve = curve + np.linalg.solve(h, x.T @ (y - q) - 1e-2 * curve)
    return Model(weights.astype(np.float32), trans, float(bias), curve)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Train on a bounded, seeded sample of labelled rows: at most
    ``sample_docs`` documents of either label in hash order, of them as many as
    ``sample_bytes`` of text hold, whole (``sample_places``), and of either label at
    least one, however long. Rows of the held-out fold, and null
    labels or ids, are never used; a document labelled twice counts as toxic if
    one label says so. Without labelled rows every score is 0."""
    known = (labels.select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).alias("toxic")).dropna()
             .filter(~held_out(F.col("_id"), FOLDS, HELD_FOLD)).groupBy("_id").agg(F.max("toxic").alias("toxic")))
    share = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64(F.lit(3), "_id"), "_id").limit(sample_docs) for t in (True, False)]
    picked = share[0].unionByName(share[1])    # at most 2 * sample_docs rows of id and label
    texts = docs.select(F.col(id_col).alias("_id"), text_column(docs, text_col).alias("text")).join(F.broadcast(picked), "_id")
    # a label takes half of the bytes, and what the other one leaves
    by_label = Window.partitionBy("toxic")
    own, both = F.sum("size").over(by_label), F.sum("size").over(Window.partitionBy(F.lit(0)))
    room = sample_bytes - F.least(both - own, F.lit(sample_bytes // 2))
    filled = sizes(texts, "toxic").select("_id", "h", "toxic", room.alias("room"), *sample_places(sample_bytes, ["toxic"]))
    fit_in = filled.filter((F.col("upto") <= F.col("room")) | (F.col("place") == 1))
    return _trained(chosen(texts, fit_in).select("_id", "text", "toxic"))


def sizes(texts: DataFrame, *keep: str) -> DataFrame:
    """Hash and length instead of the text: a sample's order is found without moving texts."""
    return texts.select("_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"), *keep)


def chosen(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id and hash are in ``rows``, a bounded sample."""
    keys = F.broadcast(rows.select("_id", "h").distinct())
    return texts.withColumn("h", F.xxhash64("text")).join(keys, ["_id", "h"], "left_semi")


def _trained(sample: DataFrame) -> Model:
    """Train on the bounded sample ``(_id, text, toxic)`` in one task: its arrays never lie
    in the driver, which gets the weights."""
    def run(batches):
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        label = np.array(toxic, bool)
        if not len(label) or label.all() or not label.any():
            return
        m = train(texts, label)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (m.weights.tobytes(), m.trans.tobytes(), m.bias, m.curve.tobytes())],
                                         names=["weights", "trans", "bias", "curve"])

    rows = sample.repartition(1).sortWithinPartitions(F.xxhash64(F.lit(4), "_id"), "_id", F.xxhash64("text"))
    made = map_arrow(rows.select("text", "toxic"), run, "weights binary, trans binary, bias double, curve binary").toArrow()
    if not made.num_rows:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), np.zeros((2, 2)), -9.0, np.array([0.0, 0.0, -30.0]))
    weights, trans, bias, curve = (made.column(c)[0].as_py() for c in ("weights", "trans", "bias", "curve"))
    return Model(np.frombuffer(weights, np.float32), np.frombuffer(trans).reshape(2, 2), bias, np.frombuffer(curve))


def sample_places(sample_bytes: int, labels: list[str], seed: int = 4, id_col: str = "_id") -> list[Column]:
    """``place`` and bytes ``upto`` a row of a bounded sample (rows of ``sizes``) in the order in which
    the rows of a label fill it: in hash order those of at most 1/64 of the bytes, then
    the longer ones by length, so a text that does not fit keeps out no text that does."""
    size = F.col("size")
    line = (Window.partitionBy(*labels, F.lit(0))
            .orderBy(F.when(size <= sample_bytes // 64, 0).otherwise(size), F.xxhash64(F.lit(seed), id_col), id_col, "h")
            .rowsBetween(Window.unboundedPreceding, 0))
    return [F.count(F.lit(1)).over(line).alias("place"), F.sum(size).over(line).alias("upto")]


def judged(m: Model, data: np.ndarray, off: np.ndarray):
    """Scores of texts, with the probability and bounds of every word."""
    index, starts, ends, before = word_features(data, off)
    p = marginals(m.weights[index].sum(axis=0, dtype=np.float64) + m.bias, before, m.trans)
    return 1 / (1 + np.exp(-np.clip(document_view(p, before) @ m.curve, -30, 30))), p, starts, ends, before


def _shared(docs: DataFrame, m: Model):
    """A broadcast of arrays only: executors need not know the class."""
    return docs.sparkSession.sparkContext.broadcast((m.weights, m.trans, m.bias, m.curve))


def clean(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores below ``least``."""
    share = _shared(docs, model)
    names = docs.columns

    def run(batches):
        m = Model(*share.value)
        for batch in batches:
            col = batch.column(len(names))
            for a, b in slices(col):
                value = judged(m, *utf8(col.slice(a, b - a)))[0]
                part = batch.slice(a, b - a).filter(pa.array(value < least))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))], names=names)

    return map_arrow(docs.select(*docs.columns, text_column(docs, text_col).alias("_text_or_empty")), run, docs.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", likely: float = 0.5) -> DataFrame:
    """``(id, score, predicted, n_spans, spans)`` of every document, scored by its
    whole text alone. ``spans`` are runs of words with a probability of at
    least ``likely``, as code point offsets ``start`` to ``end``. A null or empty
    text has no words and gets the curve's score for none."""
    share = _shared(docs, model)

    def run(batches):
        m = Model(*share.value)
        for batch in batches:
            col = batch.column(1)
            for a, b in slices(col):
                data, off = utf8(col.slice(a, b - a))
                value, p, starts, ends, before = judged(m, data, off)
                hot = np.flatnonzero(p >= likely)
                doc = np.searchsorted(before, hot, "right") - 1
                new = np.concatenate([[True], (hot[1:] != hot[:-1] + 1) | (doc[1:] != doc[:-1])]) if len(hot) else np.empty(0, bool)
                first, of = hot[new], doc[new]
                last = hot[np.append(np.flatnonzero(new)[1:] - 1, len(hot) - 1)] if len(hot) else hot
                # code points before a byte: bytes that don't continue one
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                zero = chars[off[:-1]]
                cut = np.searchsorted(of, np.arange(b - a + 1))
                span = pa.StructArray.from_arrays([pa.array(chars[starts[first]] - zero[of], pa.int64()),
                                                   pa.array(chars[ends[last]] - zero[of], pa.int64())], names=["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(value), pa.array((value >= 0.5).astype(np.int32)),
                     pa.array(np.diff(cut).astype(np.int32)), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), span)],
                    names=["id", "score", "predicted", "n_spans", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), text_column(docs, text_col).alias("text")), run,
                     f"id {kind}, score double, predicted int, n_spans int, spans array<struct<start:long,end:long>>"
                     ).withColumnRenamed("id", id_col)


def op3_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_FOLD).alias("held_out"), "score", "predicted", "n_spans", "spans")
