import ast
import pathlib

import duckdb
import pandas as pd
import pytest

from docengine.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "pages documents conversations events".split()
ROOT = pathlib.Path(__file__).parent.parent


def rows_of(df):
    df = df[sorted(df.columns)]
    clean = lambda x: None if pd.isna(x) else x.item() if hasattr(x, "item") else x
    return sorted((tuple(map(clean, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, name):
    got = catalog.queries()[name](spark, SF)
    if name not in catalog.oracle_sql():
        assert got.where("error IS NOT NULL").count() == 0 and got.count() > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.oracle_sql()[name]).fetchdf()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", "batch_results convert_json_blocks convert_markdown_result html_blocks html_to_markdown html_to_text result_fields written_files".split())
def test_references_cut_off_before_their_end(spark, tmp_path, name):
    html = ["<h1>a &amp; b &amp</h1><p>&lt;c&gt &copy; d&copy e</p>", "<title>x &quot y</title><p>AT&T &am", "<p>a && b &; &#</p>"]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()[name]).fetchdf()
    assert rows_of(catalog.queries()[name](spark, str(tmp_path)).toPandas()) == rows_of(want)


def test_markdown_sql_has_all_headings_and_items(spark, tmp_path):
    html = ["".join(f"<h{n} class=a>head <b>{n}</b></h{n}>" for n in range(1, 7)) + "<ul><li>one<li> two<br>more</li><li></li><li><p>three</p></ul><h2></h2><p>#</p><p>- x</p>", "<ol><li>a</ol><section>b</section>c<hr>d<template>e</template>"]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = duckdb.sql(catalog.oracle_sql()["html_to_markdown"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchdf()
    assert "###### head **6**\n\n- one\n\n- two\nmore" in want.markdown[want.page_id == 0].item()
    assert rows_of(catalog.queries()["html_to_markdown"](spark, str(tmp_path)).toPandas()) == rows_of(want)


def test_markdown_sql_and_query_show_all_parts(spark, tmp_path):
    html = {
        "<p>a</p><noscript><p>without scripts</p></noscript><template><h2>row</h2>": "a\n\nwithout scripts\n\n## row",
        "<pre>\nif x:\n    <b>y</b><br>z\n</pre><pre></pre><p><b>q</b>": "```\nif x:\n    y\nz\n```\n\n**q**",
        "<script>s = '<!--'</script><p>kept</p><!-- <nav> --><p>b</p><!-- </nav> -->": "kept\n\nb",
        "<script src='a'/><p>kept</p><script>s()</script>": "kept",
        "<p>a</p><!-- never <i>closed</i><p>b": "a\n\n<!-- never closed\n\nb",
    }
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    sql = catalog.oracle_sql()["html_to_markdown"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert rows_of(duckdb.sql(sql).fetchdf()) == sorted(((t, i) for i, t in enumerate(html.values())), key=repr)
    assert rows_of(catalog.queries()["html_to_markdown"](spark, str(tmp_path)).toPandas()) == rows_of(duckdb.sql(sql).fetchdf())


@pytest.mark.parametrize("name", "batch_results convert_json_blocks convert_markdown_result html_blocks html_to_markdown html_to_text result_fields written_files".split())
def test_parts_that_are_never_closed_are_shown(spark, tmp_path, name):
    html = ["<title>t</title><p>a</p><nav>menu<p>rest</p>", "<p>a</p><nav><nav>x</nav>y<p>rest</p>", "<p>a</p><nav><footer>x</nav><p>mid</p></footer><p>rest</p>", "<p>a</p><footer>rest", "<p>a</p><script>s = '<p>'; rest", "<p>a</p><style>p {} <p>rest", "<p>a</p><noscript>shown</noscript><template>too</template>"]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()[name]).fetchdf()
    assert rows_of(catalog.queries()[name](spark, str(tmp_path)).toPandas()) == rows_of(want)


def test_only_the_entry_knows_the_llm_subpackage():
    for f in (ROOT / "docengine").rglob("*.py"):
        if f.relative_to(ROOT / "docengine").parts[0] != "llm":
            assert "llm import" not in f.read_text() and ".llm." not in f.read_text(), f


def test_entry_imports():
    import __spark_entry__ as e

    assert "html_to_markdown" in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
    ast.parse((ROOT / "__spark_entry__.py").read_text())
