import math
import random

import pytest

from docengine.llm import negatives as N


def brute(rows, is_anchor, low=50, high=95):
    """Positives and negatives of every anchor by comparing it with all rows in whole numbers."""
    rows = [(i, y, v) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = list({(i, y, tuple(v)): (i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows}.values())
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for i, y, v in rows:
        if is_anchor(i):
            scored = sorted((-clip(sum(int(a) * int(b) for a, b in zip(v, w, strict=True))), j, z) for j, z, w in rows if j != i and len(v) == len(w))
            for s, j, _ in [x for x in scored if x[2] == y][:5]:
                hard = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s][:3]
                out += [(i, j, k, n, -s, -t) for k, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


def vectors(n, dim, seed, spread=1.0, labels=3):
    r = random.Random(seed)
    rows = [(i, r.randrange(labels), [r.gauss(0.3, 1) * (spread ** r.random()) for _ in range(dim)]) for i in range(n)]
    return rows + [(n + 1 + k, *rows[k % n][1:]) for k in range(n // 4)]  # copies under other ids: ties


def mined(spark, rows, anchor="id % 4 = 0", **options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*x, "more") for x in rows], "vec_id long, label int, embedding array<double>, row_key string")
    got = N.hard_negatives(spark, df, anchor=F.expr(anchor), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize(("spread", "bucket"), [(1.0, 4096), (200.0, 7), (200.0, 1)])
def test_equals_brute_force(spark, spread, bucket):
    rows = vectors(90, 5, 7, spread)
    want = brute(rows, lambda i: i % 4 == 0)
    assert want and mined(spark, rows, bucket_rows=bucket, block_rows=9) == want


def test_nulls_other_lengths_repeats_and_large_numbers(spark):
    rows = vectors(40, 3, 2)
    rows += rows[:10]
    rows += [(0, 1, [0.5, 0.5, 1.0]), (0, 2, [1.0, 1.0, 1.0]), (4, 0, [2.0]), (8, 0, [3.0]), (9, 1, [2.5]), (12, 0, []), (13, 0, []), (16, 1, []), (20, 0, [0.0, 0.0, 0.0]), (24, 1, [-0.001, 0.0, 0.0])]
    rows += [(None, 0, [1.0, 1.0, 1.0]), (28, None, [1.0, 1.0, 1.0]), (32, 0, None), (36, 0, [1.0, None, 1.0]), (40, 0, [1.0, math.nan, 1.0]), (44, 0, [math.inf, 1.0, 1.0])]
    rows += [(60, 0, [1e7, 1e7, 2.0]), (64, 0, [1e7, 1e7, 3.0]), (68, 1, [6e6, 6e6, 1.0]), (72, 0, [1e200, 1.0, 1e-200]), (73, 0, [1e160, 0.0, 0.0]), (76, 1, [1e160, 1.0, 1.0])]
    assert mined(spark, rows, bucket_rows=5, block_rows=4) == brute(rows, lambda i: i % 4 == 0)


def test_a_large_group_of_copies_ties_by_id(spark):
    rows = [(i, i % 2, [1.0, 2.0, 3.0]) for i in range(120)] + [(200 + i, i % 2, [0.7, 1.4, 2.1]) for i in range(60)]
    assert mined(spark, rows, "id = 5", bucket_rows=16) == brute(rows, lambda i: i == 5)


def test_buckets_are_passed_over_by_their_norm():
    """A bucket below the running k-th score of all anchors is never multiplied."""
    import numpy as np

    tops = N._Tops(1, 2, [-(1 << 63)])
    one = (np.array([1]), np.array([11]), np.array([0]), np.array([[3.0, 4.0]]), np.array([5.0]), 5.0)
    held = {"anchors": one, "which": np.arange(1), "high": None, "tops": tops, "same": True, "slots": np.zeros(1, np.int64)}
    bucket = lambda ids, v: {"ids": np.array(ids).tobytes(), "row_keys": np.array(ids).tobytes(), "labels": np.zeros(len(ids), np.int64).tobytes(), "vectors": np.array(v, float).tobytes(), "dim": 2, "top": float(max(np.hypot(*x) for x in v))}
    N._meet(held, bucket([2, 3], [[3, 4], [6, 8]]))
    assert tops.best[0] == [(-50, 3), (-25, 2)]
    seen = []
    real, N.products = N.products, lambda *a: seen.append(1)
    try:
        N._meet(held, bucket([4], [[1, 1]]))
    finally:
        N.products = real
    assert not seen and tops.best[0] == [(-50, 3), (-25, 2)]


def test_empty_table(spark):
    assert mined(spark, []) == []
