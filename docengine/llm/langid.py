"""Language identification with a linear-chain conditional random field.

Words are labelled with languages, so that text which switches between them is
handled word by word; a document's language is the one with most letters by
expected share. Emissions come from affixes and byte n-grams (with word-edge
marks), and from lexicons of each language's frequent words; transitions and
start scores are learned with them by the forward-backward algorithm.

Documents carry one label each. Training therefore joins short runs of words of
different documents to one sequence, so that transitions see both staying in a
language and leaving it.

Defined cases: a null, empty or letterless text is ``und`` with score 0; without
any labelled row every text is ``und``; rows with a null language are predicted
but never learned from; repeated rows get equal results; other columns pass
through and a column of the output's name is replaced. A text's length only
costs time: whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import crc_mod, give_back, string_buffers
from .textkit import LOWER, U64, as_bytes, mix, span_hashes, spans

#: Bounds of the training sample: documents of each language, words of a sequence.
DOCS_PER_LANG, SEQUENCE = 160, 40
BUCKETS = 1 << 16
#: Words of a lexicon: at least so large a share of their language's words, and so many.
LEXICON_SHARE, LEXICON_LEAST = 2e-4, 3
#: Longest text, in characters, that the sample takes where a language has shorter ones; documents of all languages.
LONGEST_SAMPLED, SAMPLE = 20_000, 20_000
STEPS = 40
SLICE_BYTES = 4 << 20
UNKNOWN = "und"

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class CrfModel:
    langs: list[str]
    weights: np.ndarray  # (BUCKETS + len(langs), len(langs))
    moves: np.ndarray  # scores of (from, to)
    start: np.ndarray
    lexicon: list[np.ndarray] = field(default_factory=list)  # sorted word hashes of each language


def _words(raw, offsets):
    data = LOWER[as_bytes(raw)]
    st, en, docs = spans(~_NOT_LETTER[data], offsets)
    return st, en, docs, data


def _features(data: np.ndarray, st: np.ndarray, en: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of orders 2 to 4 of each word with edge marks, and where each word's begin.

    The n-grams that touch an edge mark are the word's prefixes and suffixes.
    """
    size = en - st + 2
    at = np.cumsum(size) - size
    text = np.zeros(int(size.sum()), U64)
    inner = np.arange(int((en - st).sum())) - np.repeat(np.cumsum(en - st) - (en - st), en - st)
    text[np.repeat(at + 1, en - st) + inner] = data[np.repeat(st, en - st) + inner]
    text[at], text[at + size - 1] = 2, 3
    word = np.repeat(np.arange(len(st)), size)
    grams, owner = [], []
    h = text.copy()
    for order in (2, 3, 4):
        h = h[:-1] * U64(257) + text[order - 1 :]
        same = word[: len(h)] == word[order - 1 :]
        grams.append((mix(h[same] + U64(order << 40)) % U64(BUCKETS)).astype(np.int32))
        owner.append(word[: len(h)][same])
    f, o = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(o, kind="stable")
    return f[order], np.searchsorted(o[order], np.arange(len(st)))


def _lexicon_hits(model_lexicon: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(hashes), len(model_lexicon)), np.float32)
    for k, lex in enumerate(model_lexicon):
        if len(lex):
            at = np.minimum(np.searchsorted(lex, hashes), len(lex) - 1)
            out[:, k] = lex[at] == hashes
    return out


def _emissions(weights: np.ndarray, feats: np.ndarray, at: np.ndarray, lex: np.ndarray) -> np.ndarray:
    n = np.diff(np.append(at, len(feats)))
    return np.add.reduceat(weights[feats], at, axis=0) / np.sqrt(n)[:, None] + lex @ weights[BUCKETS:]


def _forward_backward(e: np.ndarray, move: np.ndarray, start: np.ndarray):
    """Marginals and expected transitions of sequences (n, t, L) of one length, and their log-likelihood."""
    n, t, k = e.shape
    top = e.max(2, keepdims=True)
    x = np.exp(e - top)
    a, b, z = np.empty_like(x), np.empty_like(x), np.empty((n, t))
    for i in range(t):
        p = start * x[:, i] if i == 0 else (a[:, i - 1] @ move) * x[:, i]
        z[:, i] = p.sum(1)
        a[:, i] = p / z[:, i, None]
    b[:, -1] = 1
    both = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        right = x[:, i + 1] * b[:, i + 1] / z[:, i + 1, None]
        b[:, i] = right @ move.T
        both += a[:, i].T @ right * move
    return a * b, both, float(np.log(z).sum() + top.sum())


def fit(texts: pa.Array, labels: list[str], langs: list[str], seed: int = 17) -> CrfModel:
    """The field of the given texts; every sequence is made of runs of 4 to 40 words."""
    raw, off = string_buffers(pc.utf8_lower(texts))
    st, en, docs, data = _words(raw, off)
    index = {x: i for i, x in enumerate(langs)}
    of_doc = np.array([index[x] for x in labels])
    h = span_hashes(data, st, en)
    distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    k = len(langs)
    lexicon = []
    for lang in range(k):
        count = np.bincount(inverse[of_doc[docs] == lang], minlength=len(distinct))
        lexicon.append(np.sort(distinct[count >= max(LEXICON_LEAST, LEXICON_SHARE * count.sum())]))
    rng = np.random.default_rng(seed)
    runs, i = [], 0
    edges = np.searchsorted(docs, np.arange(len(off)))
    for d in range(len(off) - 1):
        i = edges[d]
        while i < edges[d + 1]:
            j = min(edges[d + 1], i + int(rng.integers(4, SEQUENCE)))
            runs.append((i, j))
            i = j
    order = rng.permutation(len(runs))
    flat = np.concatenate([np.arange(*runs[r]) for r in order]) if runs else np.zeros(0, np.int64)
    n = len(flat) // SEQUENCE
    model = CrfModel(langs, np.zeros((BUCKETS + k, k), np.float32), np.zeros((k, k)), np.zeros(k), lexicon)
    if not n:
        return model
    flat = flat[: n * SEQUENCE]
    words, gold = inverse[flat], of_doc[docs[flat]].reshape(n, SEQUENCE)
    feats, at = _features(data, st[first], en[first])
    lex = _lexicon_hits(lexicon, distinct)
    scale = 1 / np.sqrt(np.diff(np.append(at, len(feats))))
    owner = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(feats))))
    hot = np.zeros((n * SEQUENCE, k), np.float32)
    hot[np.arange(len(flat)), gold.ravel()] = 1
    pairs = np.bincount((gold[:, :-1] * k + gold[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
    begin = np.bincount(gold[:, 0], minlength=k)
    params = [model.weights.astype(np.float64), model.moves, model.start]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        em = _emissions(params[0].astype(np.float32), feats, at, lex)
        e = em[words].reshape(n, SEQUENCE, k).astype(np.float64)
        marg, both, _ = _forward_backward(e, np.exp(params[1]), np.exp(params[2]))
        diff = (hot - marg.reshape(-1, k)).astype(np.float64)
        g = np.stack([np.bincount(words, diff[:, c], len(at)) for c in range(k)], 1)
        gs = g * scale[:, None]
        grad = [np.concatenate([np.stack([np.bincount(feats, gs[owner, c], BUCKETS) for c in range(k)], 1), lex.T @ g]), pairs - both, begin - marg[:, 0].sum(0)]
        for p, d, mm, vv in zip(params, grad, m, v, strict=True):
            d = d / len(flat) * 100 - 1e-3 * p
            mm *= 0.9
            mm += 0.1 * d
            vv *= 0.99
            vv += 0.01 * d * d
            p += 0.15 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-6)
    model.weights, model.moves, model.start = params[0].astype(np.float32), params[1], params[2]
    return model


def word_marginals(model: CrfModel, raw, offsets):
    """(starts, ends, docs, marginals) of the words of a batch of lower-cased texts.

    Sequences are laid out time-major, longest first: step t of the recursions
    handles the t-th word of every text that has one.
    """
    st, en, docs, data = _words(raw, offsets)
    k = len(model.langs)
    if not len(st) or not k:
        return st, en, docs, np.zeros((len(st), k))
    h = span_hashes(data, st, en)
    distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    feats, at = _features(data, st[first], en[first])
    em = _emissions(model.weights, feats, at, _lexicon_hits(model.lexicon, distinct)).astype(np.float64)
    em = np.exp(em - em.max(1, keepdims=True))
    count = np.bincount(docs, minlength=len(offsets) - 1)
    order = np.argsort(-count, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    longest = int(count.max())
    active = np.searchsorted(-count[order], -np.arange(longest), side="left")  # texts of more than t words
    row = np.cumsum(active) - active
    begin = np.cumsum(count) - count
    position = np.arange(len(st)) - begin[docs]
    place = row[position] + rank[docs]
    x = np.empty((len(st), k))
    x[place] = em[inverse]
    move, a = np.exp(model.moves), np.empty_like(x)
    bounds = [(int(r), int(n)) for r, n in zip(row, active, strict=True)]
    r, n = bounds[0]
    p = np.exp(model.start) * x[r : r + n]
    a[r : r + n] = p / p.sum(1, keepdims=True)
    for t in range(1, longest):
        q, n = bounds[t - 1][0], bounds[t][1]
        r = bounds[t][0]
        p = (a[q : q + n] @ move) * x[r : r + n]
        p /= p.sum(1, keepdims=True)
        a[r : r + n] = p
    b = np.ones_like(x)
    back = move.T
    for t in range(longest - 2, -1, -1):
        r, (q, n) = bounds[t][0], bounds[t + 1]
        p = (x[q : q + n] * b[q : q + n]) @ back
        p /= p.sum(1, keepdims=True)
        b[r : r + n] = p
    a *= b
    a /= a.sum(1, keepdims=True)
    return st, en, docs, a[place]


def label_words(model: CrfModel, text: str) -> list[tuple[str, str]]:
    """Runs of a text's words with one most probable language each: (language, words)."""
    raw, off = string_buffers(pc.utf8_lower(pa.array([text])))
    st, en, _, marg = word_marginals(model, raw, off)
    out: list[tuple[str, list[str]]] = []
    for s, e, m in zip(st, en, marg, strict=True):
        lang = model.langs[int(m.argmax())]
        word = bytes(raw[s:e]).decode("utf-8", "replace")
        if out and out[-1][0] == lang:
            out[-1][1].append(word)
        else:
            out.append((lang, [word]))
    return [(lang, " ".join(w)) for lang, w in out]


def predict(model: CrfModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and its share of letters, for each text."""
    langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    raw, off = string_buffers(low)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        part = raw[off[i] : off[j]]
        st, en, docs, marg = word_marginals(model, part, off[i : j + 1] - off[i])
        if len(st) and model.langs:
            weight = (en - st).astype(np.float64)
            share = np.stack([np.bincount(docs, weight * marg[:, c], j - i) for c in range(len(model.langs))], 1)
            total = np.bincount(docs, weight, j - i)
            plain = np.concatenate([[0], np.cumsum(as_bytes(part) < 128)])
            ascii_letters = np.bincount(docs, plain[en] > plain[st], j - i)
            for d in np.flatnonzero(total):
                # words of other signs than ASCII letters may hold none at all
                if ascii_letters[d] or any(c.isalpha() for c in low[i + int(d)].as_py()):
                    best = int(share[d].argmax())
                    langs[i + d], score[i + d] = model.langs[best], min(1.0, share[d, best] / total[d])
        i = j
    return langs, score


def train_language_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG) -> CrfModel:
    """A field fitted on about ``docs_per_lang`` whole documents of each language.

    Only documents outside the held-out fold are used. Which ones: those with
    the smallest hashes, by a threshold from the language's count, of at most
    LONGEST_SAMPLED characters (a language of longer texts alone gives two of them).
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_mod(id_col, 5) != 0))
    short = F.char_length(text_col) <= LONGEST_SAMPLED
    found = rows.groupBy(F.col(lang_col)).agg(F.count(F.lit(1)).alias("n"), F.count_if(short).alias("short")).collect()
    counts = {r[0]: r["short"] or r["n"] * docs_per_lang / 2 for r in found}
    longer = [r[0] for r in found if not r["short"]]
    docs_per_lang = min(docs_per_lang, max(1, SAMPLE // max(1, len(counts))))
    rows = rows.where(short | F.col(lang_col).isin(longer)) if longer else rows.where(short)
    if not counts:
        return CrfModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, docs_per_lang / n)).otherwise(share)
    u = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(u < share).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).orderBy(F.xxhash64(F.col("i")), "t").limit(2 * docs_per_lang * len(counts)).toArrow()
    got = got.take(pc.sort_indices(got, [("i", "ascending"), ("t", "ascending")]))
    model = fit(got.column("t").combine_chunks(), got.column("l").to_pylist(), sorted(counts))
    del got
    give_back()
    return model


def _udf(spark: SparkSession, model: CrfModel):
    held = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        lang, s = predict(held.value, texts)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(s, pa.float64())], ["lang_pred", "score"])

    score.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, "struct<lang_pred:string,score:double>")


def identify(spark: SparkSession, docs: DataFrame, model: CrfModel, *, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` of lang_pred and score; no shuffle."""
    return docs.withColumn(out, _udf(spark, model)(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def held_out(id_col: str, modulus: int) -> Column:
    """Whether the id's remainder is 0; a null id has none and is false."""
    return F.coalesce(crc_mod(id_col, modulus) == 0, F.lit(False)).alias("held_out")


def language_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Train on the table's labelled rows and predict every row."""
    model = train_language_model(docs)
    got = identify(spark, docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out("doc_id", 5), "language.lang_pred", "language.score")
