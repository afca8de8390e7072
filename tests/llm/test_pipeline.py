"""Every stage against a plain version, on its own input."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

cp = pytest.importorskip("corpus_pipeline")
from docengine.llm import langid, mixing  # noqa: E402
from docengine.llm.queries import table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "123 456", "en", "s", 7), (9003, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(odd)
    for name, f in cp.STAGES:
        before, docs = docs, cp.materialize(spark, f(spark, docs, SF), name)
        out.append((name, before, docs))
    return {n: (a, b) for n, a, b in out}


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name


def test_language(spark, stages):
    before, after = stages["language_id"]
    model = langid.train_language_model(before)
    rows = before.select("doc_id", "text").toArrow()
    lang, score = langid.predict(model, rows.column("text").combine_chunks())
    assert ids(after) == sorted(i for i, x, s in zip(rows.column("doc_id").to_pylist(), lang, score, strict=True) if x != "und" and s >= cp.LEAST_LANGUAGE_SHARE)
    assert {9001, 9002, 9003}.isdisjoint(ids(after))


def test_jaccard(spark, stages):
    before, after = stages["jaccard_join"]
    from .test_sigtree import brute

    groups = brute([tuple(r) for r in before.select("doc_id", "text").collect()])
    assert ids(after) == sorted(i for i, _, c in groups if i == c)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    from .test_decontam import brute

    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    assert ids(after) == sorted(r.doc_id for r in before.collect() if not brute(r.text, items)[3])


def test_mixing(stages):
    before, after = stages["source_mixing"]
    documents = before.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({mixing.mixing_sql()}) WHERE sampled").fetchall())
    assert ids(after) == want and 0 < len(want) < len(documents)


def test_tokens(stages):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    before, after = stages["token_output"]
    want, start = {}, 0
    for r in before.orderBy("doc_id").collect():
        x = np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        want[r.doc_id] = (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in after.collect()} == want and want


def test_empty_table_and_clashing_columns(spark):
    """No rows pass through; columns named like those made inside stay as they are; repeated rows are one."""
    docs = table(spark, SF, "documents").where("doc_id < 60")
    docs = docs.unionByName(docs.where("doc_id < 9"))
    for c in ("told", "found", "row", "topic", "probability", "component", "g_key", "id"):
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for rows in (docs.limit(0), docs):
        n = rows.count()
        for name, f in cp.STAGES:
            before, rows = rows, cp.materialize(spark, f(spark, rows, SF), name)
            if name != cp.STAGES[-1][0]:
                assert rows.columns == before.columns and rows.where("told <> 'own told' OR id <> 'own id' OR topic <> 'own topic'").isEmpty(), name
        kept = ids(rows)
        assert kept == sorted(set(kept)) and bool(kept) == bool(n)
