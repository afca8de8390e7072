"""Toxicity by noisy-channel deobfuscation.

A writer who hides a word writes other signs for letters, repeats letters or
puts spaces and signs between them. Suspicious tokens (and runs of single
letters) become a lattice of what each sign may stand for; a k-best Viterbi
search under a character language model, with a bonus for words that are known,
restores them. The restored text is then scored by a logistic model over word
and word-beginning features. Plain tokens pass unchanged, so only suspicious
ones cost a search, and each distinct one is searched once per worker.
The language model counts the words of all labelled rows; the logistic model is
fitted on a bounded sample of them.

Defined cases: a null, empty or blank text has no features and gets the model's
base rate; without labelled rows every score is 0.5; repeated rows get equal
scores; whole texts are read; other columns pass through and a column of the
output's name is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .langid import held_out
from .shared import crc_mod, give_back, in_slots, materialize, string_buffers
from .textkit import SPACE, U64, as_bytes, mix, sorted_sets, span_hashes, spans

#: Bounds: labelled rows to learn from; signs of a token that paths of the search hold as text; k of the search.
SAMPLE, LONGEST, BEST = 4000, 48, 6
#: Least share of all words of a known one, and of a trigram for each word; words that a task counts before it sends them.
KNOWN_SHARE, TRIGRAM_SHARE, HELD_WORDS = 6e-7, 2.5e-7, 300_000
THRESHOLD = 0.5
SLICE_BYTES = 2 << 20
MEMO = 200_000

# Letters that a sign may stand for.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "aeiou"}
BETWEEN = "-._*~' "
LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE = "^"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "0123456789@$!|+*#("]] = True
_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in "-._*~'"]] = True
_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in ".,;:!?\"'()[]"]] = True


@dataclass
class ToxicModel:
    chars: dict[str, float] = field(default_factory=dict)  # log probability of trigrams
    floor: float = -7.0
    known: dict[str, float] = field(default_factory=dict)  # log probability of words
    longest: int = 0  # letters of the longest of them
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    filter: np.ndarray = field(default_factory=lambda: np.zeros(1 << 20, bool))


_REPEATS = re.compile(r"(([^\W\d_])\2{7})\2+")
_WORD = re.compile(r"[^\W\d_]+")
_RANK = itemgetter(0, 1)


def _chained(last: str, before: tuple | None) -> str:
    parts = [last]
    while before:
        before, w = before
        parts.append(w)
    return "".join(reversed(parts))


def known_words(model: ToxicModel, text: str) -> list[str]:
    """The known words of a text without spaces, by its most probable division; a letter outside them costs twice the floor."""
    longest = model.longest
    best, step = [0.0] * (len(text) + 1), [1] * (len(text) + 1)
    for i in range(len(text) - 1, -1, -1):
        best[i] = best[i + 1] + 2 * model.floor
        for n in range(3, min(longest, len(text) - i) + 1):
            p = model.known.get(text[i : i + n])
            if p is not None and p + best[i + n] > best[i]:
                best[i], step[i] = p + best[i + n], n
    out, i = [], 0
    while i < len(text):
        if step[i] > 1:
            out.append(text[i : i + step[i]])
        i += step[i]
    return out


def restore(model: ToxicModel, token: str) -> str:
    """The most probable plain form of an obfuscated token.

    States are the last two letters; each keeps its BEST paths. A sign between
    letters, or a letter equal to the one before, may be skipped at a price.
    In long tokens the first eight of more equal letters stand for all, and a
    path's text is chained every LONGEST signs: the work is linear in the length.
    """
    if len(token) > LONGEST:
        token = _REPEATS.sub(r"\1", token)
    beam: dict[str, list[tuple[float, str, tuple | None]]] = {EDGE * 2: [(0.0, "", None)]}
    for i, c in enumerate(token):
        options = [(x, 0.0 if c.isalpha() else -0.7) for x in (STANDS_FOR.get(c) or (c if c.isalpha() else ""))]
        nxt: dict[str, list[tuple[float, str, tuple | None]]] = {}
        if i and i % LONGEST == 0:
            beam = {s: [(p, "", (before, w)) for p, w, before in paths] for s, paths in beam.items()}
        for state, paths in beam.items():
            moves = [(state[1] + x, cost + model.chars.get(state + x, model.floor), x) for x, cost in options]
            if c in BETWEEN or not c.isalnum():
                moves.append((state, -0.5, ""))
            elif c.isalpha() and state[1] == c and i and token[i - 1] == c:
                moves.append((state, -1.0, ""))
            for to, cost, x in moves or [(state, -3.0, "")]:
                nxt.setdefault(to, []).extend((p + cost, w + x, before) for p, w, before in paths)
        beam = {s: sorted(p, key=_RANK, reverse=True)[:BEST] for s, p in nxt.items()}
    ends = [(p + model.chars.get(s + EDGE, model.floor), _chained(w, before)) for s, paths in beam.items() for p, w, before in paths]
    # a known word: the words' own model replaces that of characters
    return max(((max(p, model.known.get(w, -1e9)) + (8.0 if w in model.known else 0.0), w) for p, w in ends), default=(0.0, ""))[1]


class _Memo:
    def __init__(self):
        self.of: dict[str, str] = {}
        self.model: ToxicModel | None = None

    def restore(self, model: ToxicModel, token: str) -> str:
        if self.model is not model or len(self.of) > MEMO:
            self.of, self.model = {}, model
        if len(token) > 20 * LONGEST:
            return restore(model, token)
        if token not in self.of:
            self.of[token] = restore(model, token)
        return self.of[token]


_memo = _Memo()


def _tokens(raw, offsets):
    """Starts, ends (outer signs trimmed), documents and bytes of white-space tokens of lower-cased text."""
    data = as_bytes(raw)
    st, en, docs = spans(~SPACE[data], offsets)
    if not len(st):
        return st, en, docs, data
    inner = ~_TRIM[data]
    head, tail = np.flatnonzero(inner | _SIGN[data]), np.flatnonzero(inner)
    after = np.searchsorted(tail, en)  # signs before it are kept up to the last one that is no outer sign
    en = np.where(after > 0, np.append(tail, -1)[after - 1] + 1, 0)
    first = np.searchsorted(head, st)
    st = np.where(first < len(head), np.append(head, len(data))[np.minimum(first, len(head))], len(data))
    ok = en > st
    return st[ok], en[ok], docs[ok], data


def suspicious(data: np.ndarray, st: np.ndarray, en: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Tokens to restore, and runs (first, last token + 1) of single signs to join."""
    letter = _LETTER[data]
    sign = _SIGN[data] | _SEP[data]
    near = np.zeros(len(data), bool)  # a sign beside a letter, or a letter thrice
    if len(data) > 2:
        near[1:] = sign[1:] & letter[:-1]
        near[:-1] |= sign[:-1] & letter[1:]
        triple = np.zeros(len(data), bool)
        triple[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 128)
        near |= triple
    flags, letters = np.concatenate([[0], np.cumsum(near)]), np.concatenate([[0], np.cumsum(letter)])
    odd = (flags[en] - flags[st] > 0) & (letters[en] - letters[st] > 0)
    single = (en - st == 1) & (letter[st] | _SIGN[data[st]])
    if len(st):
        ok = np.zeros(len(st) + 1, bool)
        ok[1:-1] = single[1:] & single[:-1] & (docs[1:] == docs[:-1])
        begin = np.flatnonzero(single & ~ok[:-1])
        end = np.flatnonzero(single & ~ok[1:]) + 1
        return odd, [(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True) if 3 <= b - a]
    return odd, []


def _features(data, st, en, docs):
    """Hashes of the word and of its first 4 and 5 bytes, each with the document."""
    out = [span_hashes(data, st, en)]
    for n in (4, 5):
        longer = en - st > n
        out.append(np.where(longer, mix(span_hashes(data, st, np.minimum(en, st + n)) + U64(n)), U64(0)))
    h, d = np.concatenate(out), np.concatenate([docs] * 3)
    keep = h != 0
    return h[keep], d[keep]


def _parts(model: ToxicModel, w: str) -> list[str]:
    """A restored token or run, and the known words in it where it is none itself, whatever its length."""
    return [w] if w in model.known else [w, *known_words(model, w)]


def text_features(model: ToxicModel, raw, offsets):
    """(hashes, documents) of the features of restored texts."""
    st, en, docs, data = _tokens(raw, offsets)
    if not len(st):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    odd, runs = suspicious(data, st, en, docs)
    more: list[tuple[bytes, int]] = []
    for i in np.flatnonzero(odd):
        t = bytes(data[st[i] : en[i]]).decode("utf-8", "replace")
        if (w := _memo.restore(model, t)) and w != t:
            more += [(x.encode(), int(docs[i])) for x in _parts(model, w)]
    for a, b in runs:
        t = "".join(bytes(data[st[i] : en[i]]).decode("utf-8", "replace") for i in range(a, b))
        if len(set(t)) > 2 and (w := _memo.restore(model, t)):
            more += [(x.encode(), int(docs[a])) for x in _parts(model, w)]
    h, d = _features(data, st, en, docs)
    if more:
        size = np.array([len(w) for w, _ in more])
        end = np.cumsum(size)
        h2, d2 = _features(as_bytes(b"".join(w for w, _ in more)), end - size, end, np.array([x for _, x in more]))
        h, d = np.concatenate([h, h2]), np.concatenate([d, d2])
    return h, d


def restored_text(model: ToxicModel, text: str) -> str:
    """The whole text with suspicious tokens and spelled-out runs restored."""
    low = text.lower()
    raw, off = string_buffers(pa.array([low]))
    st, en, docs, data = _tokens(raw, off)
    odd, runs = suspicious(data, st, en, docs) if len(st) else (np.zeros(0, bool), [])
    joined = {a: b for a, b in runs}
    out, at, i = [], 0, 0
    b = bytes(data)
    while i < len(st):
        j = joined.get(i)
        if j or odd[i]:
            j = j or i + 1
            t = b"".join(b[st[k] : en[k]] for k in range(i, j)).decode("utf-8", "replace")
            out += [b[at : st[i]], _memo.restore(model, t).encode()]
            at, i = int(en[j - 1]), j
        else:
            i += 1
    return b"".join([*out, b[at:]]).decode("utf-8", "replace")


def _slices(raw, off):
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        yield i, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def _language_model(texts: list[str], y: list[int]) -> ToxicModel:
    """Character trigrams and words of the plain tokens; both classes weigh the same."""
    model = ToxicModel()
    words: Counter[str] = Counter()
    per = [max(1, sum(1 for v in y if v == c)) for c in (0, 1)]
    for t, v in zip(texts, y, strict=True):
        for w in _WORD.findall(t):
            words[w] += 1 / per[v]
    tri: Counter[str] = Counter()
    bi: Counter[str] = Counter()
    for w, n in words.items():
        p = EDGE * 2 + w + EDGE
        for i in range(len(p) - 2):
            tri[p[i : i + 3]] += n
            bi[p[i : i + 2]] += n
    least = min(words.values(), default=1.0)
    model.chars = {k: math.log((n + least) / (bi[k[:2]] + 30 * least)) for k, n in tri.items()}
    total = sum(words.values()) or 1.0
    model.known = {w: math.log(n / total) for w, n in words.items() if n > 2.5 * least and len(w) > 2}
    model.longest = max(map(len, model.known), default=0)
    return model


def _class_words(batches):
    """Words with how often texts of each label hold them; the empty word stands for the texts themselves."""
    held: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

    def flush():
        every = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([c[w] for w in every], pa.int64()) for c in held)], ["word", "n0", "n1"])
        for c in held:
            c.clear()
        return out

    for batch in batches:
        for t, y in zip(pc.utf8_lower(batch.column("text")).to_pylist(), batch.column("y").to_pylist(), strict=True):
            held[y][""] += 1
            held[y].update(_WORD.findall(t))
        if len(held[0]) + len(held[1]) > HELD_WORDS:
            yield flush()
    yield flush()


def _word_trigrams(batches):
    for batch in batches:
        tri: dict[str, list[int]] = {}
        for w, *n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            p = EDGE * 2 + w + EDGE
            for i in range(len(p) - 2):
                own = tri.setdefault(p[i : i + 3], [0, 0])
                own[0] += n[0]
                own[1] += n[1]
        yield pa.RecordBatch.from_arrays([pa.array(list(tri), pa.string()), *(pa.array([v[k] for v in tri.values()], pa.int64()) for k in (0, 1))], ["tri", "n0", "n1"])


def labelled_texts(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> DataFrame:
    """Text and ``y`` of every label (0 or 1) outside the held-out fold.

    A shuffle moves the texts of labelled rows and few others, at every size: broadcast labels would grow with the table.
    """
    own = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 5) != 0))
    own = own.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.where(in_slots(spark, own.select("id"), F.col("id"))).join(own.hint("shuffle_hash"), "id").select("text", "y")


def train_language_model(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> ToxicModel:
    """``_language_model`` of all labelled rows outside the held-out fold; only words and trigrams above a share reach the driver."""
    words = labelled_texts(spark, docs, labels, label_col).mapInArrow(_class_words, "word string, n0 long, n1 long")
    words = materialize(spark, words.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "words")
    of = words.where("word = ''").first()
    per = [max(1, of[k]) if of else 1 for k in ("n0", "n1")]
    weight = lambda a, b: F.col(a) / float(per[0]) + F.col(b) / float(per[1])
    words = words.where("word <> ''")
    n0, n1, least = words.agg(F.sum("n0"), F.sum("n1"), F.min(weight("n0", "n1"))).first()
    model = ToxicModel()
    if least is None:
        return model
    total = n0 / per[0] + n1 / per[1]
    known = words.where((weight("n0", "n1") > max(2.5 * least, KNOWN_SHARE * total)) & (F.char_length("word") > 2)).select("word", weight("n0", "n1")).toArrow()
    model.known = {w: math.log(n / total) for w, n in sorted(zip(*(c.to_pylist() for c in known.columns), strict=True))}
    model.longest = max(map(len, model.known), default=0)
    tri = materialize(spark, words.mapInArrow(_word_trigrams, "tri string, n0 long, n1 long").groupBy("tri").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "trigrams")
    bi = tri.groupBy(F.substring("tri", 1, 2).alias("bi")).agg(F.sum("n0").alias("b0"), F.sum("n1").alias("b1"))
    tri = tri.where(weight("n0", "n1") > TRIGRAM_SHARE * total).withColumn("bi", F.substring("tri", 1, 2)).join(bi, "bi").select("tri", weight("n0", "n1"), weight("b0", "b1")).toArrow()
    model.chars = {k: math.log((n + least) / (b + 30 * least)) for k, n, b in sorted(zip(*(c.to_pylist() for c in tri.columns), strict=True))}
    return model


def fit(texts: pa.Array, y: list[int], model: ToxicModel | None = None) -> ToxicModel:
    """A model of labelled texts; its language model is that of ``model`` if given, else of the same texts."""
    low = pc.utf8_lower(texts)
    model = model or _language_model(low.to_pylist(), y)
    if not y:
        return model
    raw, off = string_buffers(low)
    hs, ds = [], []
    for i, part, o in _slices(raw, off):
        h, d = text_features(model, part, o)
        h, d = sorted_sets(h, d)
        hs.append(h)
        ds.append((d + i).astype(np.int32))
    h, d = np.concatenate(hs), np.concatenate(ds)
    y = np.asarray(y, np.float64)
    hashes, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
    n1 = np.bincount(inverse, y[d], len(hashes))
    base = y.mean()
    expect = n * base
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(n1 > 0, n1 * np.log(n1 / np.maximum(expect, 1e-12)), 0) + np.where(n > n1, (n - n1) * np.log((n - n1) / np.maximum(n - expect, 1e-12)), 0))
    chosen = np.flatnonzero((g > 15) & (n >= 4) & (n1 > expect))
    place = np.full(len(hashes), -1)
    place[chosen] = np.arange(len(chosen))
    f = place[inverse]
    f, d = f[f >= 0], d[f >= 0]
    w, b = np.zeros(len(chosen)), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    # Most features of a document are hidden in each step: few hidden words, even one, must do.
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    had, rng = np.bincount(d, minlength=len(y)) > 0, np.random.default_rng(3)
    for step in range(1, 801):
        seen = rng.random(len(f)) < rng.choice([0.15, 0.3, 1.0])
        fs, ds = f[seen], d[seen]
        counts = ~had | (np.bincount(ds, minlength=len(y)) > 0)
        z = np.bincount(ds, w[fs], len(y)) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * counts
        g = np.append(np.bincount(fs, e[ds], len(chosen)) + 0.02 * w, e.sum()) / len(y)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    model.hashes, model.weights, model.bias = hashes[chosen], w, float(b)
    model.filter = np.zeros(1 << 20, bool)
    model.filter[(model.hashes >> U64(44)).astype(np.int64)] = True
    return model


def predict(model: ToxicModel, texts: pa.Array) -> np.ndarray:
    raw, off = string_buffers(pc.utf8_lower(texts.cast(pa.large_string())))
    z = np.full(len(texts), model.bias)
    for i, part, o in _slices(raw, off):
        if not len(model.hashes):
            break
        h, d = text_features(model, part, o)
        some = model.filter[(h >> U64(44)).astype(np.int64)]
        h, d = h[some], d[some]
        at = np.minimum(np.searchsorted(model.hashes, h), len(model.hashes) - 1)
        hit = model.hashes[at] == h
        key = np.unique(d[hit] * len(model.hashes) + at[hit])
        z[i : i + len(o) - 1] += np.bincount(key // len(model.hashes), model.weights[key % len(model.hashes)], len(o) - 1)
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def score_toxicity(spark: SparkSession, docs: DataFrame, model: ToxicModel, *, text_col: str = "text", out: str = "toxicity_score") -> DataFrame:
    """``docs`` with a double column ``out``; no shuffle."""
    held = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(predict(held.value, texts), pa.float64())

    score.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.withColumn(out, F.arrow_udf(score, "double")(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def toxicity_report(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    model = fit(*labelled_sample(spark, docs, labels, "toxic", sample), train_language_model(spark, docs, labels))
    give_back()
    got = score_toxicity(spark, docs.select("doc_id", "text"), model, out="score")
    return got.select("doc_id", held_out("doc_id", 5), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
