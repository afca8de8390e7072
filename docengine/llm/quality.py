"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Every token has a sparse random index vector, given by its hash. A known word's
vector is its index vector plus those of the words next to it in the training
texts (random indexing); an unknown word takes the vector of its shape (letters,
digits and signs with runs collapsed). A document is the mean of its word
vectors, the mean of its shape vectors, the mean product of neighbouring word
vectors, and four plain rates. A two-layer numpy network maps this to a
probability, calibrated by a temperature on training rows kept apart.

Defined cases: a null, empty or blank text is a document without tokens, whose
pooled vectors are zero, and gets the network's score for it; without labelled
rows every score is 0.5; repeated rows get equal scores; other columns pass
through and a column of the output's name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .langid import held_out
from .shared import give_back, string_buffers
from .textkit import U64, mix, span_hashes, words

#: Bound: labelled rows to learn from. Words seen so often in them have a learned vector.
SAMPLE, OFTEN = 6000, 3
DIM, SIGNS, HIDDEN = 32, 4, 32
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = ord("a")
_SHAPE[48:58] = ord("0")


@dataclass
class QualityModel:
    hashes: np.ndarray  # sorted hashes of known words
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Sparse random vectors: SIGNS places of +1 or -1, from the hash alone."""
    out = np.zeros((len(hashes), DIM), np.float32)
    for i in range(SIGNS):
        h = mix(hashes + U64(i + 1))
        np.add.at(out, (np.arange(len(hashes)), (h % U64(DIM)).astype(np.int64)), np.where(h >> U64(63), 1, -1).astype(np.float32))
    return out / np.float32(np.sqrt(SIGNS))


def _tokens(raw, offsets):
    """Word hashes, shape hashes and documents of the tokens of a batch."""
    st, en, docs, data = words(raw, offsets)
    h = span_hashes(data, st, en)
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[st] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    s = span_hashes(shape[keep], place[st], place[en])
    return h, s, docs


def _vectors(model: QualityModel, h: np.ndarray, s: np.ndarray):
    shapes, inverse = np.unique(s, return_inverse=True)
    of_shape = index_vectors(shapes)
    table = np.concatenate([model.vectors, of_shape])
    row = len(model.vectors) + inverse
    known = np.zeros(len(h), bool)
    if len(model.hashes):
        at = np.minimum(np.searchsorted(model.hashes, h), len(model.hashes) - 1)
        known = model.hashes[at] == h
        row = np.where(known, at, row)
    return table, row, of_shape, inverse, known


def pooled(model: QualityModel, raw, offsets: np.ndarray) -> np.ndarray:
    """(documents, 3 * DIM + 4) inputs of the network."""
    n = len(offsets) - 1
    out = np.zeros((n, 3 * DIM + 4), np.float32)
    h, s, docs = _tokens(raw, offsets)
    if not len(h):
        return out
    count = np.bincount(docs, minlength=n)
    has = np.flatnonzero(count)
    at = (np.cumsum(count) - count)[has]
    table, row, of_shape, inverse, known = _vectors(model, h, s)
    v = table[row]
    per = count[has][:, None].astype(np.float32)
    out[has, :DIM] = np.add.reduceat(v, at) / per
    out[has, DIM : 2 * DIM] = np.add.reduceat(of_shape[inverse], at) / per
    same = np.zeros(len(h), bool)
    same[1:] = docs[1:] == docs[:-1]
    v[1:] *= v[:-1]
    v[~same] = 0
    out[has, 2 * DIM : 3 * DIM] = np.add.reduceat(v, at) / per
    equal = same.copy()
    equal[1:] &= h[1:] == h[:-1]
    out[:, 3 * DIM] = np.log1p(count)
    out[has, 3 * DIM + 1] = np.bincount(docs, equal, n)[has] / per[:, 0]
    out[has, 3 * DIM + 2] = np.bincount(docs, known, n)[has] / per[:, 0]
    out[has, 3 * DIM + 3] = np.diff(offsets)[has] / per[:, 0] / 10
    return out


def _slices(raw, off):
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        yield raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def learn_vectors(raw, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and vectors of all words that the texts have OFTEN times at least."""
    h, _, docs = _tokens(raw, offsets)
    distinct, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    best = np.flatnonzero(count >= OFTEN)
    base = index_vectors(distinct[best])
    place = np.full(len(distinct), -1)
    place[best] = np.arange(len(best))
    row = place[inverse]
    total = np.zeros_like(base)
    for gap in (1, 2):
        near = (docs[gap:] == docs[:-gap]) & (row[gap:] >= 0) & (row[:-gap] >= 0)
        left, right = row[:-gap][near], row[gap:][near]
        for c in range(DIM):
            total[:, c] += np.bincount(left, base[right, c], len(best)) + np.bincount(right, base[left, c], len(best))
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return distinct[best], base + total / np.maximum(norm, 1e-9)


def _forward(layers, x):
    a = np.maximum(x @ layers[0] + layers[1], 0)
    return a, a @ layers[2] + layers[3]


def fit(texts: pa.Array, y: list[int], seed: int = 5) -> QualityModel:
    raw, off = string_buffers(texts)
    hashes, vectors = learn_vectors(raw, off) if len(y) else (np.zeros(0, U64), np.zeros((0, DIM), np.float32))
    width = 3 * DIM + 4
    model = QualityModel(hashes, vectors.astype(np.float32), np.zeros(width), np.ones(width), (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(())), 1.0)
    if not len(y):
        return model
    x = np.concatenate([pooled(model, *p) for p in _slices(raw, off)]).astype(np.float64)
    model.mean, model.spread = x.mean(0), x.std(0) + 1e-3
    x, y = (x - model.mean) / model.spread, np.asarray(y, np.float64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart, own = order[: len(y) // 5], order[len(y) // 5 :]
    p = [rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.array(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(40):
        rng.shuffle(own)
        for k in range(0, len(own), 128):
            b = own[k : k + 128]
            a, z = _forward(p, x[b])
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) / len(b)
            back = np.outer(d, p[2]) * (a > 0)
            grads = [x[b].T @ back + 1e-3 * p[0], back.sum(0), a.T @ d + 1e-3 * p[2], d.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - 0.002 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    model.layers = tuple(p)
    z = _forward(p, x[apart])[1] if len(apart) else np.zeros(0)
    if len(z):
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
        loss = [np.mean(np.logaddexp(0, np.where(y[apart] == 1, -z, z) / t)) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def predict(model: QualityModel, texts: pa.Array) -> np.ndarray:
    raw, off = string_buffers(texts)
    if not len(texts):
        return np.zeros(0)
    x = np.concatenate([pooled(model, *p) for p in _slices(raw, off)])
    z = _forward(model.layers, (x - model.mean) / model.spread)[1] / model.temperature
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def score_quality(spark: SparkSession, docs: DataFrame, model: QualityModel, *, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with a double column ``out``; no shuffle."""
    held = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(predict(held.value, texts), pa.float64())

    score.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.withColumn(out, F.arrow_udf(score, "double")(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def quality_report(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    model = fit(*labelled_sample(spark, docs, labels, "quality", sample))
    give_back()
    got = score_quality(spark, docs.select("doc_id", "text"), model, out="score")
    return got.select("doc_id", held_out("doc_id", 5), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
