"""Language-model scoring by deleted interpolation.

A bigram model over all words of the training documents; words that none of them
has are one class. The
maximum-likelihood estimates of bigram and unigram and a uniform floor are mixed
with weights that depend on how often the context was seen; the weights are
learned by expectation-maximisation on counts of documents kept apart from those
that the estimates of this step use. Final counts are over all training documents.

Counts are never sampled or pruned. The table of the most frequent words, that of
the most frequent bigrams and the histogram that the weights are learned from have
fixed bounds and are sent to all tasks. The tables only save traffic: a bigram of
two such words meets its count in a bucket of its own hash; one with a rarer word
is keyed by the 64-bit hashes of both words and meets all its counts in the bucket
of its own word (of its context, if only that is rare). Where both are rare, it
goes on to the bucket of its context with what was counted. Only sums per document
come back.

Defined cases: null and empty texts have the end token alone; repeated rows each
count and are each scored; rows of a null id are training rows (crc32 of nothing
is not 0 modulo 10) and are scored; an empty table gives no rows; other columns
are ignored. Whole texts are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize, string_buffers, tasks_for
from .textkit import U64, mix, span_hashes, words

#: Bounds of the tables that every task holds.
VOCABULARY, FREQUENT_BIGRAMS = 65_000, 1 << 17
CONTEXTS = 24  # buckets of log2 context counts
ADD = 0.1
END, START = U64(1), U64(2)  # hashes of the end token and of a document's start; words' hashes are above 15
SLICE_BYTES = 4 << 20
STEPS = 60
PER_BUCKET = 1_500_000


@dataclass
class BigramModel:
    words: np.ndarray  # sorted hashes of the most frequent words
    counts: np.ndarray  # of words in all training documents
    n: int  # tokens
    v: int  # distinct tokens
    docs: int  # training documents
    weights: np.ndarray  # (CONTEXTS, 3): bigram, unigram, uniform
    hot: np.ndarray  # frequent bigrams, sorted
    hot_counts: np.ndarray
    every: DataFrame | None = None  # hashes of all training words; stays on the driver

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items() if k not in ("every", "vocab")}

    @cached_property
    def vocab(self) -> np.ndarray:
        """Sorted hashes of all training words, to look at; no task needs them in one place."""
        return np.sort(self.every.toArrow().column(0).to_numpy().view(U64))

    def log10(self, context: np.ndarray, count: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Of bigrams, from the counts of the context, of the bigram and of its own word."""
        return np.log10(interpolate(self.weights, context, count, own / self.n, self.v + 1))

    def packed_log10(self, bigram: np.ndarray, count: np.ndarray) -> np.ndarray:
        h, w = bigram >> np.uint32(16), bigram & np.uint32(0xFFFF)
        return self.log10(np.append(self.counts, [0, self.docs])[h], count, self.counts[w])


def interpolate(weights, context, count, unigram, size):
    lam = weights[np.minimum(np.log2(context + 1).astype(np.int64), CONTEXTS - 1)]
    return lam[:, 0] * count / np.maximum(context, 1) + lam[:, 1] * unigram + lam[:, 2] / size


def fold(doc_id, modulus: int = 10) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus if doc_id is not None else -1


def _tokens(column: pa.Array):
    """(hashes, documents) of all tokens with the end of each document, slice by slice of documents."""
    raw, off = string_buffers(column)
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        st, en, docs, data = words(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        h = np.maximum(span_hashes(data, st, en), U64(16))
        at = np.searchsorted(docs, np.arange(j - i), side="right")
        yield i, j, np.insert(h, at, END), np.insert(docs, at, np.arange(j - i))
        i = j


def _find(table: np.ndarray, h: np.ndarray):
    """Places in a sorted table, and whether the hashes are there."""
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return at, table[at] == h


def _bigrams(table: np.ndarray, h: np.ndarray, docs: np.ndarray):
    """Entry numbers, (previous << 16 | own), hashes of the previous, and whether one of the two is not in the table, of all tokens."""
    at, there = _find(table, h)
    own = np.where(there, at, len(table)).astype(np.uint32)
    prev, before = np.empty_like(own), np.empty_like(h)
    prev[1:], before[1:] = own[:-1], h[:-1]
    first = np.ones(len(own), bool)
    first[1:] = docs[1:] != docs[:-1]
    prev[first], before[first] = len(table) + 1, START
    return own, prev << np.uint32(16) | own, before, ~there | (prev == len(table))


def _pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One 64-bit number for a bigram of word hashes."""
    return mix(h * U64(0x9E3779B97F4A7C15) + mix(w))


def _split(bucket: np.ndarray, buckets: int):
    """(bucket, places) of the buckets that have any."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edge)):
        yield int(b), order[edge[b] : edge[b + 1]]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(U64)) % U64(buckets)).astype(np.int64)


def _home(h: np.ndarray, w: np.ndarray, w_rare: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a bigram with a rare word: that of its own word, or of its context if only that is rare."""
    return _bucket(np.where(w_rare, w, h), buckets)


def _look_up(words: np.ndarray, n: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, there = _find(words, h)
    return np.where(there, n[at], 0) if len(words) else np.zeros(len(h), np.int64)


def _rare_counts(table, counts, starts: int, h, w, n):
    """Counts of own words and of contexts (-1: in another bucket) of a bucket's distinct bigrams with a rare word, and of its rare words.

    All bigrams that end in a rare word of the bucket are here, so their sum is the word's
    count, and the count of the same word as a context.
    """
    at, common = _find(table, w)
    own = counts[at].astype(np.int64)
    words, back = np.unique(w[~common], return_inverse=True)
    of = np.bincount(back, n[~common], len(words)).astype(np.int64)
    own[~common] = of[back]
    at, there = _find(table, h)
    context = np.where(there, counts[at], -1).astype(np.int64)
    context[h == START] = starts
    here = (context < 0) & common
    context[here] = _look_up(words, of, h[here])
    return own, context, words, of, ~common


class _Counter:
    """Counts of keys over a partition, for two kinds of documents."""

    def __init__(self):
        self.parts: list = []
        self.size = 0

    def add(self, keys: np.ndarray, kept_apart: np.ndarray) -> None:
        k, inverse = np.unique(keys, return_inverse=True)
        self.parts.append((k, np.bincount(inverse, minlength=len(k)), np.bincount(inverse, kept_apart, len(k)).astype(np.int64)))
        self.size += len(k)
        if self.size > 4_000_000:
            self.merge()

    def merge(self):
        if not self.parts:
            return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        k, inverse = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        n, a = (np.bincount(inverse, np.concatenate([p[i] for p in self.parts]), len(k)).astype(np.int64) for i in (1, 2))
        self.parts, self.size = [(k, n, a)], len(k) // 2
        return k, n, a

    def blobs(self, buckets: int):
        k, n, a = self.merge()
        for b, o in _split(_bucket(k, buckets), buckets):
            yield b, k[o].tobytes(), None, n[o].astype(np.uint32).tobytes(), a[o].astype(np.uint32).tobytes()


def _sum_pairs(parts):
    """Distinct bigrams (context, own word) of parts (contexts, own words, n, apart), with their sums."""
    h, w, n, a = (np.concatenate([np.zeros(0, t), *(p[i] for p in parts)]) for i, t in enumerate((U64, U64, np.int64, np.int64)))
    _, first, inverse = np.unique(_pair(h, w), return_index=True, return_inverse=True)
    return h[first], w[first], np.bincount(inverse, n, len(first)).astype(np.int64), np.bincount(inverse, a, len(first)).astype(np.int64)


def _pair_blobs(parts, table: np.ndarray, buckets: int):
    h, w, n, a = _sum_pairs(parts)
    for b, o in _split(_home(h, w, ~_find(table, w)[1], buckets), buckets):
        yield b, h[o].tobytes(), w[o].tobytes(), n[o].astype(np.uint32).tobytes(), a[o].astype(np.uint32).tobytes()


_BLOB = "bucket int, keys binary, own binary, n binary, apart binary"


def _blob_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], ["bucket", "keys", "own", "n", "apart"])


def _blob_batches(rows):
    rows = list(rows)
    for k in range(0, len(rows), 64):
        yield _blob_batch(rows[k : k + 64])


def _count(buckets: int, table_of=None):
    """Counts of words (or, given the table of frequent words, of bigrams) of training documents."""

    def run(batches):
        total, pairs, held = _Counter(), [], 0
        for batch in batches:
            folds = np.array([fold(x) for x in batch.column(0).to_pylist()])
            for i, j, h, docs in _tokens(batch.column(1)):
                f = folds[i:j][docs]
                if table_of is None:
                    total.add(h[f != 0], f[f != 0] == 1)
                    continue
                _, two, before, rare = _bigrams(table_of.value, h, docs)
                own = (f != 0) & ~rare
                total.add(two[own], f[own] == 1)
                own = (f != 0) & rare
                pairs.append(_sum_pairs([(before[own], h[own], np.ones(int(own.sum()), np.int64), (f[own] == 1).astype(np.int64))]))
                held += len(pairs[-1][0])
                if held > 2_000_000:
                    yield from _blob_batches(_pair_blobs(pairs, table_of.value, buckets))
                    pairs, held = [], 0
        yield from _blob_batches(total.blobs(buckets))
        if held:
            yield from _blob_batches(_pair_blobs(pairs, table_of.value, buckets))

    return run


def _total(rows, dtype):
    k, n, a = (np.concatenate([np.zeros(0, t), *(np.frombuffer(r[i], t) for r in rows)]) for i, t in ((0, dtype), (2, np.uint32), (3, np.uint32)))
    k, inverse = np.unique(k, return_inverse=True)
    return k, np.bincount(inverse, n, len(k)).astype(np.int64), np.bincount(inverse, a, len(k)).astype(np.int64)


def _blob_rows(batches):
    return [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("keys", "own", "n", "apart")), strict=True)]


def _all_words(batches):
    yield pa.RecordBatch.from_arrays([pa.array(_total(_blob_rows(batches), U64)[0].view(np.int64))], ["key"])


def _words_of_bucket(top: int):
    def run(batches):
        k, n, a = _total(_blob_rows(batches), U64)
        best = np.argsort(-n, kind="stable")[:top]
        names = ["key", "n", "apart", "distinct"]
        yield pa.RecordBatch.from_arrays([pa.array(k[best].view(np.int64)), pa.array(n[best]), pa.array(a[best]), pa.nulls(len(best), pa.int64())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([int(n.sum())]), pa.array([int(a.sum())]), pa.array([len(k)])], names)

    return run


_TWO = "key long, two long, one long, n long, bucket int, keys binary, data binary"
_WORDS, _ONWARD = -1, -2  # in place of ``two``: counts of a bucket's rare words, bigrams that go on to their contexts


def _two_batch(rows: int, **columns):
    types = {"key": pa.int64(), "two": pa.int64(), "one": pa.int64(), "n": pa.int64(), "bucket": pa.int32(), "keys": pa.binary(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in types.items()], list(types))


def _histogram(context, left, one, rest: int, apart):
    """Rows of (level and step of the bigram's share, step of the word's share, held-out count)."""
    level = np.minimum(np.log2(context + 1).astype(np.int64), CONTEXTS - 1)
    step = lambda f: np.where(f > 0, np.rint(-8 * np.log2(np.maximum(f, 1e-30))), 900).astype(np.int64)
    code = (level * 1024 + step(left / np.maximum(context, 1))) * 1024 + step(one / max(1, rest))
    distinct, inverse = np.unique(code, return_inverse=True)
    return _two_batch(len(distinct), two=distinct // 1024, one=distinct % 1024, n=np.bincount(inverse, apart, len(distinct)).astype(np.int64))


def _bigrams_of_bucket(shared, top: int, buckets: int):
    def run(batches):
        table, counts, apart, n_all, n_apart, docs, docs_apart = shared.value
        rows = _blob_rows(batches)
        k, n, a = _total([r for r in rows if r[1] is None], np.uint32)
        best = np.argsort(-n, kind="stable")[:top]
        yield _two_batch(len(best), key=k[best].astype(np.int64), n=n[best])
        held = a > 0
        k, n, a = k[held], n[held], a[held]
        own = counts - apart
        h, w = k >> np.uint32(16), k & np.uint32(0xFFFF)
        yield _histogram(np.append(own, [0, docs - docs_apart])[h], n - a, own[w], n_all - n_apart, a)
        # bigrams with a rare word
        h, w, n, a = _sum_pairs([(*(np.frombuffer(x, U64) for x in r[:2]), *(np.frombuffer(x, np.uint32) for x in r[2:])) for r in rows if r[1] is not None])
        one, context, words, of, _ = _rare_counts(table, own, docs - docs_apart, h, w, n - a)
        told = (a > 0) & (context >= 0)
        yield _histogram(context[told], (n - a)[told], one[told], n_all - n_apart, a[told])
        for b, o in _split(_bucket(words, buckets), buckets):
            yield _two_batch(1, two=[_WORDS], bucket=[b], keys=[words[o].tobytes()], data=[of[o].tobytes()])
        on = np.flatnonzero((a > 0) & (context < 0))
        for b, o in _split(_bucket(h[on], buckets), buckets):
            o = on[o]
            yield _two_batch(1, two=[_ONWARD], bucket=[b], keys=[h[o].tobytes()], data=[np.stack([n[o] - a[o], one[o], a[o]]).tobytes()])

    return run


def _contexts_of_bucket(rest: int):
    """The histogram of bigrams of two rare words."""

    def run(batches):
        rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("two", "keys", "data")), strict=True)]
        words, of = _word_table([(k, d) for t, k, d in rows if t == _WORDS])
        h = np.concatenate([np.zeros(0, U64), *(np.frombuffer(k, U64) for t, k, _ in rows if t == _ONWARD)])
        data = np.concatenate([np.zeros((3, 0), np.int64), *(np.frombuffer(d, np.int64).reshape(3, -1) for t, _, d in rows if t == _ONWARD)], 1)
        yield _histogram(_look_up(words, of, h), data[0], data[1], rest, data[2])

    return run


def _word_table(blobs):
    """Sorted rare words and their counts."""
    words = np.concatenate([np.zeros(0, U64), *(np.frombuffer(k, U64) for k, _ in blobs)])
    of = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(d, np.int64) for _, d in blobs)])
    order = np.argsort(words)
    return words[order], of[order]


def learn_weights(level: np.ndarray, f2: np.ndarray, f1: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Mixture weights of each context bucket, by expectation-maximisation on held-out counts.

    Buckets without counts take the weights learned over all buckets.
    """
    parts = np.stack([f2, f1, np.full(len(f1), 1 / size)], 1)
    out = np.tile(np.array([0.3, 0.6, 0.1]), (CONTEXTS, 1))

    def em(rows):
        lam = np.array([0.3, 0.6, 0.1])
        for _ in range(STEPS):
            share = parts[rows] * lam
            share *= (n[rows] / share.sum(1))[:, None]
            lam = share.sum(0) / share.sum()
        return np.maximum(lam, 1e-6) / np.maximum(lam, 1e-6).sum()

    if len(n):
        out[:] = em(np.arange(len(n)))
        for k in np.unique(level):
            out[k] = em(np.flatnonzero(level == k))
    return out


def train(spark: SparkSession, docs: DataFrame) -> tuple[BigramModel, int]:
    """The model of the training documents of ``docs`` (doc_id, text), and the number of buckets used."""
    n_docs = docs.select("doc_id").count()
    buckets = tasks_for(spark, n_docs, 4000)
    top = -(-4 * VOCABULARY // buckets)
    counted = docs.mapInArrow(_count(buckets), _BLOB).repartition(buckets, "bucket")
    got = materialize(spark, counted.mapInArrow(_words_of_bucket(top), "key long, n long, apart long, distinct long"), "words")
    n, n_apart, v = (int(x or 0) for x in got.where("key IS NULL").agg(F.sum("n"), F.sum("apart"), F.sum("distinct")).first())
    most = got.where("key IS NOT NULL").orderBy(F.col("key") != 1, F.desc("n"), "key").limit(VOCABULARY).toArrow()
    if not most.num_rows:
        most = pa.table({"key": pa.array([1], pa.int64()), "n": pa.array([0], pa.int64()), "apart": pa.array([0], pa.int64())})
    h, c, a = (most.column(x).to_numpy() for x in ("key", "n", "apart"))
    order = np.argsort(h.view(U64))
    table, c, a = h.view(U64)[order], c[order], a[order]
    end = int(np.searchsorted(table, END))
    apart_docs, train_docs = int(a[end]), int(c[end])
    every = counted.mapInArrow(_all_words, "key long")
    buckets = tasks_for(spark, n, PER_BUCKET)
    held = spark.sparkContext.broadcast(table)
    shared = spark.sparkContext.broadcast((table, c, a, n, n_apart, train_docs, apart_docs))
    top = -(-4 * FREQUENT_BIGRAMS // buckets)
    two = docs.mapInArrow(_count(buckets, held), _BLOB).repartition(buckets, "bucket").mapInArrow(_bigrams_of_bucket(shared, top, buckets), _TWO)
    two = materialize(spark, two, "bigrams")
    hot = two.where("key IS NOT NULL").orderBy(F.desc("n"), "key").limit(FREQUENT_BIGRAMS).select("key", "n").toArrow().sort_by("key")
    onward = two.where("bucket IS NOT NULL").repartition(buckets, "bucket").mapInArrow(_contexts_of_bucket(n - n_apart), _TWO)
    histogram = two.where("key IS NULL AND bucket IS NULL").unionByName(onward).groupBy("two", "one").agg(F.sum("n").alias("n")).toArrow()
    t, s1, m = (histogram.column(x).to_numpy() for x in ("two", "one", "n"))
    s2, level = t % 1024, t // 1024
    prob = lambda s: np.where(s == 900, 0.0, 2.0 ** (-s / 8.0))
    weights = learn_weights(level, prob(s2), prob(s1), m, v + 1)
    return BigramModel(table, c, n, v, train_docs, weights, hot.column("key").to_numpy().astype(np.uint32), hot.column("n").to_numpy(), every), buckets


# --- scoring ----------------------------------------------------------------------

_ROWS = "bucket int, batch long, kind int, keys binary, own binary, docs binary, data binary"
#: ``batch`` of rows that come before those of batches of documents.
_FIRST = -1


def _row_batch(rows):
    types = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["bucket", "batch", "kind", "keys", "own", "docs", "data"])


def _row_batches(rows, many: int = 64):
    some = []
    for r in rows:
        some.append(r)
        if len(some) == many:
            yield _row_batch(some)
            some = []
    if some:
        yield _row_batch(some)


def _scatter(model_of, buckets: int):
    """What a task can sum itself, as one row a batch; bigrams of frequent words (kind 1) and with a rare word (kind 2) for their buckets."""

    def run(batches):
        from pyspark import TaskContext

        model, serial = model_of.value, 0
        base_n = np.log10(model.n + ADD * (model.v + 1))
        base = np.append(np.log10(model.counts + ADD) - base_n, 0)
        for batch in batches:
            ids = batch.column(0)
            folds = np.array([fold(x) for x in ids.to_pylist()])
            for i, j, h, docs in _tokens(batch.column(1)):
                number = (TaskContext.get().partitionId() << 24) + serial
                serial += 1
                own, two, before, rare = _bigrams(model.words, h, docs)
                training = (folds[i:j] != 0).astype(np.uint8)
                w_rare = own == len(model.words)
                count = j - i
                sums = np.zeros((3, count))  # score, base, known
                sums[1] = np.bincount(docs, base[own], count)
                sums[2] = np.bincount(docs, (~w_rare) & (np.append(model.counts, 0)[own] > 0), count)
                at, hot = _find(model.hot, two)
                hot &= ~rare
                sums[0] = np.bincount(docs[hot], model.packed_log10(two[hot], model.hot_counts[at[hot]]), count)
                info = np.stack([ids.slice(i, count).fill_null(0).to_numpy(), ids.slice(i, count).is_valid().to_numpy(zero_copy_only=False), folds[i:j], np.bincount(docs, minlength=count)]).astype(np.int64)
                rows = [(int(number % buckets), number, 0, None, None, info.tobytes(), sums.tobytes())]
                cold = ~rare & ~hot
                keys, d = two[cold], docs[cold].astype(np.uint32)
                rows += [(b, number, 1, keys[o].tobytes(), None, d[o].tobytes(), training.tobytes()) for b, o in _split(_bucket(keys, buckets), buckets)]
                keys, w, d = before[rare], h[rare], docs[rare].astype(np.uint32)
                rows += [(b, number, 2, keys[o].tobytes(), w[o].tobytes(), d[o].tobytes(), training.tobytes()) for b, o in _split(_home(keys, w, w_rare[rare], buckets), buckets)]
                yield from _row_batches(rows, 128)

    return run


def _sum_rows(buckets: int, number: int, kind: int, d, n: int, terms):
    """The row of a batch of ``n`` documents with the sums of tokens' terms."""
    sums = np.zeros((3, n))
    for s, term in enumerate(terms):
        sums[s] = np.bincount(d, term, n)
    touched = np.flatnonzero(np.bincount(d, minlength=n))
    return int(number % buckets), number, kind, None, None, touched.astype(np.uint32).tobytes(), sums[:, touched].tobytes()


def _gather(model_of, buckets: int):
    """Counts and sums inside a bucket; one row per batch of documents and kind goes on.

    Bigrams of two rare words go on to the buckets of their contexts (kind 4), with
    their own and their word's count, and so do the counts of rare words (kind 3).
    """

    def run(batches):
        model = model_of.value
        kept = {1: [], 2: []}
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("batch", "kind", "keys", "own", "docs", "data")), strict=True):
                if r[1] == 0:
                    yield _row_batch([(int(r[0] % buckets), r[0], 0, None, None, r[4], r[5])])
                else:
                    kept[r[1]].append(r)
        base_n = np.log10(model.n + ADD * (model.v + 1))
        for kind, rows in kept.items():
            if not rows:
                continue
            keys = np.concatenate([np.frombuffer(r[2], np.uint32 if kind == 1 else U64) for r in rows])
            docs = [np.frombuffer(r[4], np.uint32) for r in rows]
            training = [np.frombuffer(r[5], np.uint8) for r in rows]
            if kind == 2:
                own = np.concatenate([np.frombuffer(r[3], U64) for r in rows])
                _, first, inverse = np.unique(_pair(keys, own), return_index=True, return_inverse=True)
            else:
                distinct, inverse = np.unique(keys, return_inverse=True)
                first = distinct
            count = np.bincount(inverse, np.concatenate([t[d] for t, d in zip(training, docs, strict=True)]), len(first)).astype(np.int64)
            if kind == 1:
                terms = (model.packed_log10(distinct, count),)
            else:
                one, context, words, of, rare = _rare_counts(model.words, model.counts, model.docs, keys[first], own[first], count)
                terms = (np.where(context < 0, 0, model.log10(np.maximum(context, 0), count, one)), np.where(rare, np.log10(one + ADD) - base_n, 0), (rare & (one > 0)).astype(np.float64))
            edge = np.cumsum([0, *map(len, docs)])
            yield from _row_batches(_sum_rows(buckets, r[0], kind, d, len(t), [x[inverse[e : e + len(d)]] for x in terms]) for r, d, t, e in zip(rows, docs, training, edge, strict=False))
            if kind == 2:
                yield from _row_batches((b, _FIRST, 3, words[o].tobytes(), None, None, of[o].tobytes()) for b, o in _split(_bucket(words, buckets), buckets))
                on = np.flatnonzero(context[inverse] < 0)
                number = np.repeat([r[0] for r in rows], [len(d) for d in docs])[on]
                size = np.repeat([len(t) for t in training], [len(d) for d in docs])[on]
                p, d = inverse[on], np.concatenate(docs)[on]
                data = np.stack([number, size, d, count[p], one[p]]).astype(np.int64)
                yield from _row_batches((b, _FIRST, 4, keys[on[o]].tobytes(), None, None, data[:, o].tobytes()) for b, o in _split(_bucket(keys[on], buckets), buckets))

    return run


def _added(rows):
    """(batch, info, sums) of rows that come sorted by batch and kind."""
    last, info, sums = None, None, None
    for number, kind, docs, data in rows:
        if number != last:
            if last is not None:
                yield last, info, sums
            last = number
        if kind == 0:
            info = np.frombuffer(docs, np.int64).reshape(4, -1)
            sums = np.frombuffer(data).reshape(3, -1).copy()
        else:
            sums[:, np.frombuffer(docs, np.uint32)] += np.frombuffer(data).reshape(3, -1)
    if last is not None:
        yield last, info, sums


def _finish(model_of, buckets: int):
    """Sums of bigrams of two rare words in the buckets of their contexts; rows of a batch of documents are added up to one."""

    def run(batches):
        model = model_of.value
        tables, onward = [], []

        def later():
            for batch in batches:
                for number, kind, keys, docs, data in zip(*(batch.column(c).to_pylist() for c in ("batch", "kind", "keys", "docs", "data")), strict=True):
                    if kind == 3:
                        tables.append((keys, data))
                    elif kind == 4:
                        onward.append((keys, data))
                    else:
                        yield number, kind, docs, data

        yield from _row_batches((int(number % buckets), number, 0, None, None, info.tobytes(), sums.tobytes()) for number, info, sums in _added(later()))
        if not onward:
            return
        words, of = _word_table(tables)
        h = np.concatenate([np.frombuffer(k, U64) for k, _ in onward])
        number, size, d, count, one = np.concatenate([np.frombuffer(x, np.int64).reshape(5, -1) for _, x in onward], 1)
        term = model.log10(_look_up(words, of, h), count, one)
        batch, first, inverse = np.unique(number, return_index=True, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        edge = np.searchsorted(inverse[order], np.arange(len(batch) + 1))
        yield from _row_batches(_sum_rows(buckets, int(x), 4, d[o], int(size[f]), [term[o]]) for x, f, o in ((batch[k], first[k], order[edge[k] : edge[k + 1]]) for k in range(len(batch))))

    return run


def _collect(batches):
    """Add up the rows of each batch of documents (they come sorted by batch and kind)."""
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("batch", "kind", "docs", "data")), strict=True))
    for _, info, sums in _added(rows):
        yield pa.RecordBatch.from_arrays([pa.array(info[0], mask=info[1] == 0), pa.array(info[2] == 0), pa.array(info[3]), pa.array(np.rint(sums[2]).astype(np.int64)), pa.array(sums[1]), pa.array(sums[0])], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_documents(spark: SparkSession, docs: DataFrame, model: BigramModel, buckets: int) -> DataFrame:
    held = spark.sparkContext.broadcast(model)
    rows = docs.mapInArrow(_scatter(held, buckets), _ROWS).repartition(buckets, "bucket").mapInArrow(_gather(held, buckets), _ROWS)
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("batch", "kind").mapInArrow(_finish(held, buckets), _ROWS)
    summed = rows.repartition(buckets, "batch").sortWithinPartitions("batch", "kind").mapInArrow(_collect, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def language_model_scores(spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows outside the held-out fold and score every row."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    model, buckets = train(spark, docs)
    return score_documents(spark, docs, model, buckets)
