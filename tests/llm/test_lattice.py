import numpy as np
import pytest

from docengine.llm import lattice as L


def brute(rows, cosine=0.9):
    x = [None if r[1] is None or not len(r[1]) or not all(v is not None and np.isfinite(v) for v in r[1]) or not any(r[1]) else np.array(r[1], np.float64) / np.abs(r[1]).max() for r in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= cosine] for i in range(n)]
    comp = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in link[i]:
                if comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return {rows[i][0]: (len(link[i]), min(rows[j][0] for j in range(n) if comp[j] == comp[i])) for i in range(n)}


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(200, 8)) * 2
    p = L.nearest_e8(y)
    d = ((y - p) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all()  # the covering radius
    near = ((y[:, None] - p[:, None] - L.e8_roots()[None]) ** 2).sum(2)
    assert (near >= d[:, None] - 1e-9).all()
    assert len(L.e8_roots()) == 240


def test_recall_near_the_bound():
    rng = np.random.default_rng(1)
    n, dim = 1500, 64
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(n, dim))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    found = np.zeros(n, bool)
    for t in range(L.TABLES):
        a, b = L.cells(x, t), L.cells(y, t)
        found |= (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
    assert found.mean() >= 0.9


@pytest.mark.parametrize("tile", [1500, 7])
def test_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(L, "TILE", tile)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(4):
        base = rng.normal(size=16)
        rows += [[len(rows) + k, (base + rng.normal(size=16) * (0.05 + 0.08 * (k % 4)) * (c + 1)).tolist()] for k in range(12)]
    rows += [[100 + i, rng.normal(size=16).tolist()] for i in range(20)]
    rows += [[200, rows[3][1]], [201, rows[3][1]], [202, None], [203, []], [204, [0.0] * 16], [205, [float("nan")] + [1.0] * 15], [206, [float("inf")] + [1.0] * 15], [207, [1.0, 2.0]], [208, [2.0, 4.0]], [209, [None, 1.0]], [210, [1e-300, 1e-300]], [211, [1e200, 1e200]]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: r for r in L.near_duplicate_vectors(spark, df).collect()}
    assert len(got) == len(rows)
    for i, (links, comp) in brute(rows).items():
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links, comp, i == comp), i


def test_empty(spark):
    assert L.near_duplicate_vectors(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("cut", [1, 3, 10, 1000])
def test_small_cells_equal_brute_force_however_batches_are_cut(cut):
    import pyarrow as pa

    rng = np.random.default_rng(cut)
    rows = []
    for cell, n in enumerate(rng.integers(1, 12, 60)):
        base = rng.normal(size=8)
        rows += [(cell, int(rng.integers(0, 10**6)), bool(rng.random() < 0.5), np.rint(100 * (x := base + rng.normal(size=8) * 0.2) / np.abs(x).max()).astype(np.int8)) for _ in range(n)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([r[2] for r in part]), pa.array([r[3].tobytes() for r in part], pa.binary())], ["cell", "id", "home", "small"]) for part in (rows[i : i + cut] for i in range(0, len(rows), cut))]
    got = [r for b in L._link_small_cells(0.9)(iter(batches)) for r in b.to_pylist()]

    def classes(edges):
        up = {}
        find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
        for u, v in edges:
            up[find(u)] = find(v)
        return {frozenset(y for y in up if find(y) == find(x)) for x in up}

    unit = [r[3] / np.linalg.norm(r[3].astype(float)) for r in rows]
    want = [(a[1], b[1]) for i, a in enumerate(rows) for j, b in enumerate(rows) if i != j and a[0] == b[0] and a[2] and unit[i] @ unit[j] >= 0.9]
    assert classes((r["u"], r["v"]) for r in got) == classes(want) and want


@pytest.mark.parametrize("dim", [16, 128, 384])
def test_recall_at_other_lengths(dim):
    rng = np.random.default_rng(dim)
    x, z = rng.normal(size=(2, 600, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    found = np.zeros(600, bool)
    for t in range(L.TABLES):
        a, b = L.cells(x, t), L.cells(y, t)
        found |= (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
    assert found.mean() >= 0.98


@pytest.mark.parametrize("cut", [1, 2, 5, 1000])
def test_rows_that_meet_equal_brute_force_however_batches_are_cut(cut):
    import pyarrow as pa

    rng = np.random.default_rng(cut)
    rows = []
    for cell, n in enumerate(rng.integers(1, 9, 80)):
        home = sorted((rng.random(n) < 0.2).tolist(), reverse=True)
        rows += [(cell, len(rows) + k, home[k]) for k in range(n)]
    batches = [pa.RecordBatch.from_arrays([pa.array([2 * c + (not h) for c, _, h in rows[i : i + cut]]), pa.array([r[1] for r in rows[i : i + cut]])], ["place", "id"]) for i in range(0, len(rows), cut)]
    batches.insert(1, batches[0].slice(0, 0))
    most = 4
    got = [(r["cell"], r["id"], r["home"], r["over"]) for b in L._meeting(most)(iter(batches)) for r in b.to_pylist()]
    size = np.bincount([r[0] for r in rows])
    homes = np.bincount([r[0] for r in rows], [r[2] for r in rows])
    first = {c: i for c, i, _ in reversed(rows)}
    assert got == [(*r, r[1] - first[r[0]] >= most) for r in rows if size[r[0]] > 1 and homes[r[0]]] and any(r[3] for r in got)


def test_keys_beyond_the_broadcast_bound_are_joined_by_parts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from docengine.llm import components as C

    rows = spark.createDataFrame([(k, i) for k in range(6) for i in range(10 * k)], "key long, id long")

    def groups():
        return sorted(tuple(r) for r in C.tiled(spark, rows, F.col("key"), F.col("id"), 15).select("g_key", "id", "g_i", "g_j", "g_side").collect())

    want = groups()
    monkeypatch.setattr(C, "FEW_KEYS", 0)
    assert groups() == want and len(want) > rows.count()


def test_repeated_rows_and_ids_are_as_in_sql(spark):
    import duckdb
    import pandas as pd

    from docengine.llm import oracles

    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (3, [1.0, 0.01]), (4, [-1.0, 0.0])]
    got = sorted(tuple(r) for r in L.near_duplicate_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).select("vec_id", "n_links", "component_id", "kept").collect())
    embeddings = pd.DataFrame(rows, columns=["vec_id", "embedding"])  # noqa: F841  (read by name)
    want = sorted(map(tuple, duckdb.sql(oracles.NEAR_VECTORS).fetchall()))
    assert got == want and (1, 2, 1, True) in got
