import random

import pytest

from docengine.llm import sigtree as S


def shingle_set(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    comp = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                a, b = sets[i], sets[j]
                if i != j and a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 80 * len(a | b) and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, comp, strict=True)]


def corpus():
    rng = random.Random(3)
    word = lambda: "w%d" % rng.randrange(5000)
    rows, i = [], 0
    for size in (6, 30, 90, 200):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for k in range(9):
                t = list(base)
                for _ in range(k * size // 70):
                    t[rng.randrange(size)] = word()
                rows.append((i, " ".join(t)))
                i += 1
    passage = " ".join(word() for _ in range(60))
    rows += [(i + k, passage + " " + " ".join(word() for _ in range(rng.randrange(0, 60)))) for k in range(40)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one two"), (504, "ONE\ttwo"), (505, "one two three"), (506, "Größe É x y z"), (507, "größe É x y z"), (508, "GRÖßE É x y z"), (509, rows[4][1]), (510, rows[4][1]), (511, "a a a a a a a a"), (512, "a a a a a"), (513, " ".join(word() for _ in range(20000)))]
    return rows


@pytest.mark.parametrize("tiles", [(2000, 512), (5, 4)])
def test_equals_brute_force(spark, monkeypatch, tiles):
    monkeypatch.setattr(S, "TILE_ROWS", tiles[0])
    monkeypatch.setattr(S, "TILE_TEXTS", tiles[1])
    if tiles[0] == 5:
        monkeypatch.setattr(S, "FREQUENT", 8)
        monkeypatch.setattr(S, "SPREAD", 6)
    rows = corpus()
    rng = random.Random(1)
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame([(i, t, 1) for i, t in shuffled], "doc_id long, text string, vertex int").repartition(5)
    got = sorted(map(tuple, S.jaccard_components(spark, df).collect()))
    assert got == sorted(brute(rows))


def test_bounds():
    for a in range(1, 60):
        for b in range(1, 60):
            i = S.least_overlap(a, b)
            assert 100 * i >= 80 * (a + b - i) and not 100 * (i - 1) >= 80 * (a + b - i + 1)
    assert S.listed(5) == 2 and S.listed(1) == 1 and S.listed(0) == 0


def test_keep_one_with_repeats_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(3, long, "a"), (1, long + " end", "b"), (1, long + " end", "b"), (None, long, "c"), (7, None, "d"), (8, "", "e"), (9, "other text", "f"), (None, None, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, vertex string")
    got = S.keep_one(spark, df)
    assert got.columns == df.columns
    assert sorted(r.vertex for r in got.collect()) == ["b", "c", "d", "e", "f", "g"]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.jaccard_components(spark, none).collect() == [] and S.keep_one(spark, none).collect() == []


def test_exact_phase_takes_the_vertex_text_of_repeated_ids():
    import numpy as np
    import pyarrow as pa

    from docengine.llm import sigtree as S

    a, b, other = (" ".join(f"{p}{i}" for i in range(40)) for p in ("w", "w", "z"))
    b += " more"
    v = S._sums(*S.text_sets(pa.array([a, b]), np.zeros(0, S.U64))).view(np.int64).tolist()
    columns = {"g_key": [1] * 4, "g_i": [0] * 4, "g_j": [0] * 4, "g_id": [v[0], v[0], v[1], v[1]], "g_class": pa.nulls(4, pa.int64()), "text": [other, a, other, b]}
    batch = pa.RecordBatch.from_pydict(columns)
    assert sum(x.num_rows for x in S._real(iter([batch]))) == 1


def test_large_sets_need_little_memory():
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, (4, 26_000)).astype(np.uint64)
    sets, family = [], []
    for k in range(60):
        own = rng.integers(0, 1 << 62, 3000 if k % 2 else 20_000).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[k % 4][: 17_000], own])))
        family.append(k % 4 if k % 2 else 10 + k)
    brute = [[100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for b in sets] for a in sets[:12]]
    tracemalloc.start()
    root = S.exact_links(sets)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    for i, row in enumerate(brute):
        assert [bool(root[i] == root[j]) for j in range(60)] == row


def test_two_texts_of_one_old_hash(spark):
    """Words that are each other's complement in two letters had one hash in a polynomial modulo a power of two."""
    t = "a"
    for _ in range(10):
        t += t.translate(str.maketrans("ab", "ba"))
    u = t.translate(str.maketrans("ab", "ba"))
    got = S.jaccard_components(spark, spark.createDataFrame([(1, t), (2, u), (3, t)], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_long_texts_under_chance_shingles_part_before_they_are_moved(spark, monkeypatch):
    rng = random.Random(5)
    passages = [" ".join(f"p{k}_{i}" for i in range(140)) for k in range(3)]
    rows = []
    for k in range(20):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(900 + 20 * k))
        rows += [(2 * k, f"{own} {' '.join(passages)}"), (2 * k + 1, f"{own} {' '.join(passages)} end")]
    cut, meet = [], S.meet

    def seen(spark, rows, large, link, *args):
        if link is S._real:
            cut.append(large is not None)
        return meet(spark, rows, large, link, *args)

    monkeypatch.setattr(S, "meet", seen)
    monkeypatch.setattr(S, "TILE_TEXTS", 8)
    got = {r.doc_id: r.component_id for r in S.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(40)}
    assert cut == [False]


def test_lists_and_shared_codes_are_not_shuffled_by_one_query(spark, monkeypatch):
    rows = corpus()
    plans, write = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda session, df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), write(session, df, name))[1])
    got = S.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert not [name for name, plan in plans if "MapInArrow make" in plan and "MapInArrow _by_vertex" in plan]
    assert [name for name, plan in plans if "MapInArrow make" in plan] and [name for name, plan in plans if "MapInArrow _by_vertex" in plan]
