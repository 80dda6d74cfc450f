"""Operator 2: toxicity by a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed vectors of the word and of its first
letters, so forms of a stem not seen in training share most of it.  Filters of
several widths slide over the whole text, the largest answer of each is kept
(max pooling), and a logistic layer turns them into a score.  Training runs on
the driver over a bounded sample of labelled rows (``max_train``); a part of it is held back to scale the scores and to set a
threshold for each language.

Scoring multiplies nothing by position: each filter row is applied to each
distinct word once, and a text's answers are sums of looked-up rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import chunks, documents

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
PREFIXES = (3, 4, 5)
BATCH = 64
#: Words of a text that are pooled at a time.
STRETCH = 1 << 14
#: Hashed features of fewer training texts keep a zero vector.
MIN_DOCS = 3


@dataclass
class Model:
    """Weights: ``embedding`` (buckets x dim), ``filters`` {width: (width, dim, n)}, ``bias``, ``out``, ``out_bias``; ``scale`` and ``shift`` of the score; thresholds."""

    buckets: int
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)
    default_threshold: float = 0.3

    def widths(self) -> list[int]:
        return sorted(self.filters)


class Vocabulary(dict):
    """Word bytes -> index of its row of hashed features, up to a fixed number of words at a time."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets
        self.features = array("i")

    def __missing__(self, word: bytes) -> int:
        b = self.buckets
        self.features.extend((zlib.crc32(word) % b, *(zlib.crc32(word[:n], n) % b for n in PREFIXES)))
        k = self[word] = len(self)
        return k

    def rows(self, first: int = 0) -> np.ndarray:
        """The hashed features of the words from the ``first`` on."""
        n = 1 + len(PREFIXES)
        return np.frombuffer(self.features, np.int32, offset=4 * n * first).reshape(-1, n).copy() if len(self) > first else np.empty((0, n), np.int32)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _evidence(texts: list[np.ndarray], features: np.ndarray, labels: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: whether enough texts hold it (what hardly any holds says nothing of the next one), and the signed root of the likelihood ratio of its tie to the label, the embedding's first column to begin with."""
    with_it = np.zeros((2, buckets))
    for ids, label in zip(texts, labels, strict=True):
        with_it[int(label), np.unique(features[ids])] += 1
    totals = np.array([[(labels == 0).sum()], [(labels == 1).sum()]])
    without = totals - with_it
    share = with_it.sum(0) / totals.sum()
    expected = np.stack([totals * share, totals * (1 - share)])
    observed = np.stack([with_it, without])
    g = 2 * (observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9))).sum((0, 1))
    sign = np.sign(with_it[1] / totals[1] - with_it[0] / totals[0])
    return with_it.sum(0) >= MIN_DOCS, (sign * np.sqrt(np.maximum(g, 0)) / 6).astype(np.float32)


def _fit_network(texts: list[np.ndarray], features: np.ndarray, labels: np.ndarray, buckets: int, dim: int, n_filters: int, widths: tuple[int, ...], epochs: int, rate: float, seed: int) -> Model:
    """Adam over mini-batches; max pooling passes a gradient to one place of each filter only."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    known, evidence = _evidence(texts, features, labels, buckets)
    emb[:, 0] = evidence
    emb[~known] = 0
    filters = {w: rng.normal(0, 0.5 / np.sqrt(w * dim), (w, dim, n_filters)).astype(np.float32) for w in widths}
    for w in widths:  # half of the filters begin by reading the evidence at one of their places
        filters[w][np.arange(n_filters // 2) % w, 0, np.arange(n_filters // 2)] = 1.0
    total = n_filters * len(widths)
    bias, out_bias = np.zeros(total, np.float32), np.float32(-1.0)
    out = np.where(np.arange(total) % n_filters < n_filters // 2, 0.3, rng.normal(0, 0.1, total)).astype(np.float32)
    params = {"bias": bias, "out": out, **{f"w{w}": filters[w] for w in widths}}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    emb_m = np.zeros(buckets, np.float32)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6)).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            grad_bias_out = np.float32(0)
            rows: list[np.ndarray] = []
            row_grads: list[np.ndarray] = []
            for d in batch.tolist():
                ids = texts[d]
                best, places = _pool(ids, emb, features, filters, widths)
                pooled = np.concatenate([best[w] for w in widths]) if len(ids) else np.zeros(total, np.float32)
                hidden = pooled + bias
                active = hidden > 0
                z = float((hidden * active) @ out + out_bias)
                g = np.float32((1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - labels[d]) * weight[d])
                grads["out"] += g * hidden * active
                grad_bias_out += g
                back = g * out * active
                grads["bias"] += back
                for j, w in enumerate(widths):
                    if w not in places:
                        continue
                    top, own = places[w], back[j * n_filters : (j + 1) * n_filters]
                    for k in range(min(w, len(ids))):
                        inside = np.flatnonzero(top + k < len(ids))  # the rest is padding
                        at_top = features[ids[top[inside] + k]]
                        grads[f"w{w}"][k][:, inside] += (emb[at_top].sum(1) * own[inside, None]).T
                        rows.append(at_top)
                        row_grads.append((filters[w][k][:, inside] * own[inside]).T)
            step += 1
            n = len(batch)
            for k, v in params.items():
                m, s = moments[k]
                g = grads[k] / n
                m *= 0.9
                m += 0.1 * g
                s *= 0.99
                s += 0.01 * g * g
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
            out_bias -= rate * grad_bias_out / n
            if rows:  # the embedding: one running square for each row touched
                own_rows = np.concatenate(rows)
                own_grads = np.repeat(np.concatenate(row_grads)[:, None, :], own_rows.shape[1], 1).reshape(-1, dim) / n
                flat = own_rows.ravel()
                own_grads, flat = own_grads[known[flat]], flat[known[flat]]
                keys, inverse = np.unique(flat, return_inverse=True)
                summed = np.zeros((len(keys), dim), np.float32)
                np.add.at(summed, inverse, own_grads)
                emb_m[keys] += (summed**2).mean(1)
                emb[keys] -= 0.05 * summed / (np.sqrt(emb_m[keys])[:, None] + 1e-8)
    return Model(buckets, emb, filters, bias, out, float(out_bias))


def _pool(ids: np.ndarray, emb: np.ndarray, features: np.ndarray, filters: dict[int, np.ndarray], widths: tuple[int, ...]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Each filter's largest answer over a whole text and its (first) place, by width; a long text is read a stretch at a time."""
    best: dict[int, np.ndarray] = {}
    places: dict[int, np.ndarray] = {}
    for first in range(0, len(ids), STRETCH):
        x = emb[features[ids[first : first + STRETCH + max(widths) - 1]]].sum(1)
        for w in widths:
            if first and len(x) < w:
                continue
            answer = _convolve(x[: STRETCH + w - 1], filters[w])
            top = answer.argmax(0)
            largest = answer[top, np.arange(answer.shape[1])]
            if first:
                more = largest > best[w]
                best[w], places[w] = np.where(more, largest, best[w]), np.where(more, top + first, places[w])
            else:
                best[w], places[w] = largest, top
    return best, places


def _convolve(x: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """Answers (places, filters) of one width; a text shorter than the filter is padded by zeros behind."""
    w = len(filters)
    if not len(x):
        return np.empty((0, filters.shape[2]), np.float32)
    if len(x) < w:
        x = np.concatenate([x, np.zeros((w - len(x), x.shape[1]), x.dtype)])
    n = len(x) - w + 1
    out = x[:n] @ filters[0]
    for k in range(1, w):
        out += x[k : k + n] @ filters[k]
    return out


class Scorer:
    """Applies a model; keeps the filters' answers to the words seen, up to ``most`` words."""

    def __init__(self, model: Model, most: int = 120_000):
        self.model, self.most = model, most
        self.widths = model.widths()
        # columns: for each width and place in the filter, its filters
        self.stack = np.concatenate([model.filters[w][k] for w in self.widths for k in range(w)], 1)
        self.clear()

    def clear(self) -> None:
        self.words = Vocabulary(self.model.buckets)
        self.rows = np.zeros((1024, self.stack.shape[1]), np.float32)
        self.done = 0

    def _answers(self) -> None:
        n = len(self.words)
        if n > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(n - len(self.rows), len(self.rows)), self.rows.shape[1]), np.float32)])
        if n > self.done:
            self.rows[self.done : n] = self.model.embedding[self.words.rows(self.done)].sum(1) @ self.stack
            self.done = n

    def logits(self, texts: list[bytes]) -> np.ndarray:
        if len(self.words) > self.most:
            self.clear()
        ids = [self.words.of(words_of(t)) for t in texts]
        self._answers()
        m, n_filters = self.model, self.model.filters[self.widths[0]].shape[2]
        pooled = np.zeros((len(ids), n_filters * len(self.widths)), np.float32)
        for d, own in enumerate(ids):
            n = len(own)
            if not n:
                continue
            at = 0
            for j, w in enumerate(self.widths):
                size = max(n - w + 1, 1)
                best = None
                for first in range(0, size, STRETCH):  # long texts a stretch at a time
                    last = min(size, first + STRETCH)
                    total = None
                    for k in range(w):
                        part = own[first + k : min(last + k, n)]
                        got = self.rows[part, at + k * n_filters : at + (k + 1) * n_filters]
                        if total is None:
                            total = got
                        else:
                            total[: len(got)] += got
                    top = total.max(0)
                    best = top if best is None else np.maximum(best, top)
                pooled[d, j * n_filters : (j + 1) * n_filters] = best
                at += w * n_filters
        hidden = np.maximum(pooled + m.bias, 0)
        return (hidden @ m.out + m.out_bias).astype(np.float64)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.logits(texts) * self.model.scale + self.model.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of the labels to the logits (Newton's method with a weak prior)."""
    spread = max(float(z.std()), 1e-6)
    x = np.stack([z / spread, np.ones_like(z)], 1)
    theta = np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - y) + np.array([0.02, 0.0]) * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.02, 1e-6])
        theta -= np.linalg.solve(hess, grad)
    return float(theta[0] / spread), float(theta[1])


def best_threshold(scores: np.ndarray, y: np.ndarray, otherwise: float) -> float:
    """The middle of the gap at which F1 is largest (``otherwise`` without labels of both kinds)."""
    if not len(y) or y.min() == y.max():
        return otherwise
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # not between equal scores
    k = int(f1.argmax())
    below = s[k + 1] if k + 1 < len(s) else 0.0
    return float((s[k] + below) / 2)


def train(
    labelled: DataFrame,
    max_train: int = 8_000,
    buckets: int = 1 << 15,
    dim: int = 12,
    n_filters: int = 8,
    widths: tuple[int, ...] = (1, 2, 3),
    epochs: int = 4,
    min_steps: int = 400,
    rate: float = 0.01,
    seed: int = 7,
) -> Model:
    """Fit on at most ``max_train`` rows of (text, lang, label), see ``training_rows``; one in five calibrates.

    Texts are whole, in the fit as in scoring; their number alone is bounded.  A
    small sample is gone through more often, for ``min_steps`` steps.  Rows
    without a label or text are left out; without both labels the model
    answers with the labels' share.
    """
    rows = labelled.where("label is not null and text is not null").select("text", "lang", F.col("label").cast("int").alias("label"))
    sample = sorted(((zlib.crc32(r["text"].encode()), r["text"], r["label"], r["lang"]) for r in rows.limit(max_train).collect()), key=lambda r: (r[0], r[1], r[2], r[3] or ""))
    texts, langs = [r[1].encode() for r in sample], [r[3] for r in sample]
    labels = np.array([r[2] for r in sample], np.float64)
    del sample
    empty = Model(buckets, np.zeros((buckets, dim), np.float32), {w: np.zeros((w, dim, n_filters), np.float32) for w in widths}, np.zeros(n_filters * len(widths), np.float32), np.zeros(n_filters * len(widths), np.float32), 0.0)
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1.0)
        empty.shift = float(np.log(share / (1 - share)))
        return empty
    vocabulary = Vocabulary(buckets)
    ids = [vocabulary.of(words_of(t)) for t in texts]
    features = vocabulary.rows()
    del vocabulary
    held = np.arange(len(ids)) % 5 == 4
    fit = np.flatnonzero(~held)
    epochs = max(epochs, -(-min_steps * BATCH // len(fit)))
    model = _fit_network([ids[k] for k in fit], features, labels[fit], buckets, dim, n_filters, tuple(widths), epochs, rate, seed)
    enough = min(labels[held].sum(), (1 - labels[held]).sum()) >= 10
    own = np.flatnonzero(held) if enough else np.arange(len(ids))  # few rows: those of the fit calibrate too
    scorer = Scorer(model)
    z, y = scorer.logits([texts[k] for k in own]), labels[own]
    model.scale, model.shift = _calibrate(z, y)
    scores = scorer.scores([texts[k] for k in own])
    # the shift puts the threshold of best F1 at the default one, so a score is read alike after every fit
    cut = float(np.clip(best_threshold(scores, y, model.default_threshold), 1e-6, 1 - 1e-6))
    model.shift += np.log(model.default_threshold / (1 - model.default_threshold)) - np.log(cut / (1 - cut))
    scores = scorer.scores([texts[k] for k in own])
    own_langs = np.array([langs[k] or "" for k in own])
    for lang in sorted(set(own_langs.tolist())):
        mask = own_langs == lang
        enough = mask.sum() >= 50 and len(np.unique(y[mask])) == 2
        model.thresholds[lang or None] = best_threshold(scores[mask], y[mask], model.default_threshold) if enough else model.default_threshold
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text; null text counts as empty, and an empty text has the score of no words."""
    rows = documents(docs)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch, texts in chunks(batches, "text", 1 << 22):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.scores(texts))], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = 8_000) -> DataFrame:
    """(text, lang, label) of labelled documents that are not held out: about 19 in 20 of ``max_train``, by a hash of the id.

    The labels are sampled before they meet the texts, so few rows are joined.
    Of several labels of one document the largest counts, so none multiplies a
    text; a document that stands in several rows gives each of them.
    """
    own = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").alias("label")).where("label_id is not null and label is not null").where(~held_out("label_id"))
    own = own.groupBy("label_id").agg(F.max("label").alias("label"))
    n = own.count()
    if n > max_train:
        of = 1 << 30
        own = own.where(F.pmod(F.xxhash64("label_id"), F.lit(of)) < int(of * 0.95 * max_train / n))
    return docs.select("doc_id", "text", "lang").join(own, F.col("doc_id") == F.col("label_id")).select("text", "lang", "label")


def remove_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold of their language (the default one for others)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch, texts in chunks(batches, "text", 1 << 22):
            cut = [shared.value.thresholds.get(x, shared.value.default_threshold) for x in batch.column("lang").to_pylist()]
            yield batch.filter(pa.array(scorer.scores([t or b"" for t in texts]) < np.array(cut)))

    return docs.mapInArrow(run, docs.schema)
