import hashlib
import re

import pytest

from docengine.llm import decontam as D

W = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items):
    w = re.findall(W, lower(text))
    hit, who = set(), set()
    for item, t in items:
        q = re.findall(W, lower(t))
        k = min(13, len(q))
        for i in range(len(q) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j : j + k] == q[i : i + k]:
                    hit.update(range(j, j + k))
                    who.add(str(item))
    return len(w), len(hit), sorted(who), bool(hit) and 20 * len(hit) >= len(w)


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, "Short item, here"), (10, "Short item, here"), (3, ""), (4, None), (5, "über Straße 東京 x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11"), (2, "Short item, here")]
TEXTS = ["", None, "!!! ---", "a short ITEM here! and SHORT--item\nhere", "W3 w4, " + " ".join(f"w{i}" for i in range(5, 16)) + " tail", " ".join(f"w{i}" for i in range(5, 17)), LONG + " " + LONG, "pad " * 300 + "short item here", "pad " * 57 + "short item here", "ÜBER über straße 東京 x1 x2 x3 x4 x5 x6 x7 x8 x9 x10", "über Straße 東京 x1 x2 x3 x4 x5 x6 x7 x8 x9 x10"]


@pytest.mark.parametrize("part_bytes", [1 << 20, 30])
def test_equals_brute_force(spark, part_bytes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, TEXTS[3]])], "doc_id long, text string, decontam string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r for r in D.contamination_report(docs, bench, part_bytes=part_bytes).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate([*TEXTS, TEXTS[3]]):
        n, hit, who, bad = brute(t, ITEMS)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(who), bad), t
        assert r["items_sha256"] == hashlib.sha256(",".join(who).encode()).hexdigest()


def test_spans_point_into_the_original(spark):
    text = "Ünï -- SHORT, item:\n\there. And more"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(2, "short item here")], "item_id long, text string")
    (s,) = D.decontaminate(docs, bench).first()["decontam"]["spans"]
    assert text[s["start"] : s["end"]] == "SHORT, item:\n\there"


def test_empty_benchmark_and_null_item_id(spark):
    docs = spark.createDataFrame([(1, "short item here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination_report(docs, none).first()["contaminated"] is False
    nameless = spark.createDataFrame([(None, "short item here")], "item_id long, text string")
    r = D.contamination_report(docs, nameless).first()
    assert (r["n_hit"], r["n_items"], r["contaminated"]) == (3, 0, True)


@pytest.mark.parametrize("codes", [1, 3, 7])
def test_more_words_than_code_points(spark, monkeypatch, codes):
    """Words of two code points each: the same answers, and no match begins inside a word."""
    import random

    monkeypatch.setattr(D, "CODES", codes)
    r = random.Random(codes)
    vocabulary = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 16)))) for i in range(12)]
    if codes > 1:
        items = [(i, " ".join(r.choices(vocabulary[:6], k=2))) for i in range(6)]
    texts = [" ".join(r.choices([*vocabulary, "other"], k=r.randint(0, 60))) for _ in range(60)]
    a = D.Windows(items)
    assert a.wide == (2 if len(a.signs) > codes else 1)
    for t in texts:
        n, hit, who = a.scan(t)
        assert (n, 0 if hit is None else int(hit.sum()), sorted(map(str, who))) == brute(t, items)[:3]


def test_empty_documents_and_a_very_long_text(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.contamination_report(spark.createDataFrame([], "doc_id long, text string"), bench).collect() == []
    docs = spark.createDataFrame([(1, "pad " * 400_000 + LONG)], "doc_id long, text string")
    r = D.contamination_report(docs, bench).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (400_040, 40, False)
