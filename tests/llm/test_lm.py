import math
from collections import Counter

import numpy as np
import pytest

from docengine.llm import lm

TEXTS = ["the cat sat on the mat", "the dog sat on the mat", None, "", "The CAT sat\ton a mat", "unseen words only here", "the cat sat on the mat"] + [f"the cat number{i} sat on the mat again and again" for i in range(60)]


@pytest.mark.parametrize("vocabulary,hot", [(65_000, 1 << 17), (6, 3)])
def test_counts_and_scores_equal_a_plain_model(spark, monkeypatch, vocabulary, hot):
    monkeypatch.setattr(lm, "VOCABULARY", vocabulary)
    monkeypatch.setattr(lm, "FREQUENT_BIGRAMS", hot)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "the cat sat on the mat"), (None, "the cat")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    docs = df.selectExpr("doc_id", "coalesce(text, '') as text")
    model, buckets = lm.train(spark, docs)
    got = lm.score_documents(spark, docs, model, buckets).collect()
    assert len(got) == len(rows)
    tokens = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    train = [w for (i, _), w in zip(rows, tokens, strict=True) if lm.fold(i) != 0]
    c = Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    assert (model.n, model.v, model.docs) == (n, v, len(train))
    # the plain model uses the learned vocabulary and weights, and counts of its own
    from docengine.llm.textkit import span_hashes

    def entry(x):
        if x is None:
            h = lm.END
        else:
            h = span_hashes(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0]
        at = np.searchsorted(model.vocab, h)
        return int(at) if at < len(model.vocab) and model.vocab[at] == h else len(model.vocab)

    two, one = Counter(), Counter()
    for w in train:
        e = [len(model.vocab) + 1, *map(entry, w)]
        two.update(zip(e, e[1:]))
        one.update(e)
    inside = sum(k for x, k in c.items() if entry(x) == len(model.vocab))

    def score(w):
        e, s = [len(model.vocab) + 1, *map(entry, w)], 0.0
        for h, x, word in zip(e, e[1:], w):
            lam = model.weights[min(int(math.log2(one[h] + 1)), lm.CONTEXTS - 1)]
            s += math.log10(lam[0] * two[h, x] / max(1, one[h]) + lam[1] * one[x] / n + lam[2] / (len(model.vocab) + 1))
            if x == len(model.vocab):
                s += math.log10((c[word] + 0.1) / (inside + 0.1 * (v - len(model.vocab) + 1)))
        return s

    want = sorted((i is None, i or 0, lm.fold(i) == 0, len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6), round(score(w), 6)) for (i, _), w in zip(rows, tokens, strict=True))
    have = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert have == want
    assert {r.train_tokens for r in got} == {n}


def test_weights_find_a_mixture():
    rng = np.random.default_rng(0)
    f2, f1 = rng.random(4000), rng.random(4000) * 0.1
    n = np.rint(1e5 * (0.7 * f2 + 0.25 * f1 + 0.05 / 50)).astype(int)
    assert lm.learn_weights(np.full(4000, 3), f2, f1, n, 50)[3, 0] > 0.6
    assert np.allclose(lm.learn_weights(np.zeros(0, int), f2[:0], f1[:0], n[:0], 50).sum(1), 1)


def test_empty(spark):
    assert lm.language_model_scores(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []

def test_words_beyond_the_table_have_counts_of_their_own(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the rare{i % 5} tail{i % 5} end word{i % 7} of it") for i in range(120)], "doc_id long, text string").repartition(3)
    whole = {r.doc_id: r for r in lm.language_model_scores(spark, docs).collect()}
    monkeypatch.setattr(lm, "VOCABULARY", 4)
    monkeypatch.setattr(lm, "FREQUENT_BIGRAMS", 2)
    monkeypatch.setattr(lm, "PER_BUCKET", 100)
    few = {r.doc_id: r for r in lm.language_model_scores(spark, docs).collect()}
    assert len(few) == len(whole) == 120
    for i, r in whole.items():
        assert few[i].score == pytest.approx(r.score, abs=1e-6) and few[i].base_score == pytest.approx(r.base_score, abs=1e-6)
        assert few[i].n_known == r.n_known
