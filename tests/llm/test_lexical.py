import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from docengine.llm import lexical as L

CLASS = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def terms(t):
    return re.findall(CLASS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=10):
    """All documents scored for all items."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in set(items):
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * b[w] // (1000 * b[w] + 8 * m)) for w in terms(text) if w in b)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(n, seed=3):
    r = random.Random(seed)
    words = [[f"{c}{i}" for i in range(40)] for c in "abc"]
    return [(i, " ".join(r.choices(words[i % 3], [1 / (k + 1) for k in range(40)], k=r.randint(0, 40)))) for i in range(n)]


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*x, "s", 7) for x in docs], "doc_id long, text string, leaf string, n int")
    q = spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, term string")
    got = L.ranked_documents(spark, d, q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


ITEMS = [(1, "a1 a2 a3 A1"), (2, "b0 b39, c7"), (3, "a0 b0 c0 nowhere"), (4, ""), (5, None), (6, "never seen"), (2, "b0 b39, c7"), (None, "c1 c2")]


@pytest.mark.parametrize(("shard", "first", "levels"), [(4096, 8, 5), (7, 1, 3), (1, 2, 0)])
def test_equals_brute_force(spark, shard, first, levels):
    docs = corpus(150) + [(None, "a1 a2"), (None, None), (500, ""), (501, "--- !!"), (502, "Über über ÜBER x1"), (3, "a1 a2 a3")]
    assert found(spark, docs, [*ITEMS, (9, "ÜBER über")], shard_docs=shard, first=first, levels=levels) == brute(docs, [*ITEMS, (9, "ÜBER über")])


def test_ties_copies_and_a_very_long_text(spark):
    docs = [(i, "a1 b2 same text") for i in range(300, 100, -1)] + [(7, "a1 " + "pad " * 60_000 + "b2")] + corpus(40, 5)
    items = [(1, "same b2"), (2, "a1"), (3, "pad")]
    got = found(spark, docs, items, shard_docs=16, first=2)
    assert got == brute(docs, items)
    assert [d for i, _, d, _ in sorted(got, key=lambda x: (x[0], x[1])) if i == 1] == list(range(101, 111))


def test_repeated_rows_are_documents_and_empty_tables(spark):
    docs = [(4, "a b"), (4, "a b"), (5, "c")]
    assert found(spark, docs, [(1, "b")]) == brute(docs, [(1, "b")])
    assert found(spark, [], [(1, "b")]) == [] and found(spark, docs, []) == []


def test_bisection_puts_like_documents_together():
    doc = np.repeat(np.arange(60), 6)
    r = np.random.default_rng(0)
    term = np.concatenate([r.choice(20, 6, replace=False) + 20 * (d % 2) for d in range(60)])
    side, left, right = L.bisect(doc, term, 60)
    assert side.sum() == 30 and len({(d % 2, s) for d, s in enumerate(side)}) == 2
    assert (left + right == np.bincount(term, minlength=40)).all()
    order = L.Order(doc, L.mix(term.astype(np.uint64)), 60, levels=2)
    leaf, _ = order.places(doc, L.mix(term.astype(np.uint64)), 60)
    assert not set(leaf[::2]) & set(leaf[1::2]) and abs(order.share.sum() - 1) < 1e-9


def test_shards_that_cannot_hold_a_result_are_passed_over(spark):
    """After the first round only shards with a bound of the k-th score and more are read."""
    docs = [(i, "rare " * 3 + "x") for i in range(12)] + [(100 + i, f"rare {'y ' * 30}z{i}") for i in range(60)]
    seen = []
    real = L._visit
    L._visit = lambda spark, shards, visits, *a: (seen.append(visits.count()), real(spark, shards, visits, *a))[1]
    try:
        got = found(spark, docs, [(1, "rare x")], shard_docs=12, first=2, levels=1)
    finally:
        L._visit = real
    assert got == brute(docs, [(1, "rare x")]) and sum(seen) < -(-72 // 12)


def test_wanted_terms_are_never_missed(spark):
    h = L.mix(np.arange(5000).astype(np.uint64))
    table = L.wanted_terms(spark.createDataFrame([(int(x),) for x in h.astype(np.int64)], "term long"))
    assert L._is_wanted(h, table).all()
    assert L._is_wanted(L.mix(np.arange(5000, 105000).astype(np.uint64)), table).mean() < 0.05
