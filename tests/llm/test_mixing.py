import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docengine.llm import mixing as M

ROWS = [(i, ("a | b " if i % 4 == 0 else "word ") * (i % 60 + 1), "en" if i % 3 else "de", f"s{i % 5 if i % 2 else 0}") for i in range(300)] + [(300, None, None, None), (301, "", "en", "s0"), (None, "x y", "en", "s1"), (5, "again", "en", "s0")]


def frame(spark):
    return spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, lang string, source string, factor int")


def test_equals_sql(spark):
    documents = pd.DataFrame(ROWS, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(M.mixing_sql()).fetchall(), key=repr)
    got = M.mixing_report(spark, frame(spark))
    assert sorted((tuple(r[c] for c in ("doc_id", "n_tokens", "topic", "factor", "probability", "sampled")) for r in got.collect()), key=repr) == want


def test_margins_meet_given_targets(spark):
    cells = spark.createDataFrame([("a", "en", "x", 100), ("a", "de", "x", 50), ("b", "en", "x", 30), ("b", "de", "y", 20)], "source string, lang string, topic string, tokens long")
    goal = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, share double"), "lang": spark.createDataFrame([("en", 0.6), ("de", 0.4)], "lang string, share double")}
    raked = M.rake(spark, cells, goal, rounds=20)
    for dim, want in (("source", {"a": 100, "b": 100}), ("lang", {"en": 120, "de": 80})):
        got = {r[0]: r[1] for r in raked.groupBy(dim).agg(F.sum("w")).collect()}
        assert got == pytest.approx(want, rel=1e-4)


def test_sampling_keeps_columns_and_whole_shares(spark):
    df = frame(spark)
    got = M.sample_documents(spark, df)
    assert got.columns == df.columns
    want = {r.doc_id for r in M.mixing_report(spark, df).where("sampled").collect()}
    assert {r.doc_id for r in got.collect()} == want and 0 < len(want) < len(ROWS)


def test_empty_and_tokenless(spark):
    none = frame(spark).limit(0)
    assert M.mixing_report(spark, none).collect() == [] and M.sample_documents(spark, none).collect() == []
    blank = spark.createDataFrame([(1, "", "en", "a"), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    assert {r.probability for r in M.mixing_report(spark, blank).collect()} == {1.0}
