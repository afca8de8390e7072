import pytest
from hypothesis import given
from hypothesis import settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docengine.functions import ranges as R
from docengine.operators.convert import page_numbers


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_parse_keeps_order_and_duplicates(spark):
    got = values(spark, R.parse_pages(F.col("r")), [("0,2,4-6",), (" 5-6 ,,0, 5",), ("",), (",",)], "r string")
    assert got == [[0, 2, 4, 5, 6], [5, 6, 0, 5], [], []]


@pytest.mark.parametrize("bad", ["5-3", "-5", "5-", "1-2-3", "a", "1,b"])
def test_malformed_ranges_raise(spark, bad):
    with pytest.raises(Exception):
        values(spark, R.parse_pages(F.col("r")), [(bad,)], "r string")


def test_compact(spark):
    rows = [([0, 2, 4, 5, 6],), ([],), ([3, 2, 1],), ([1, 1, 2],), ([7],), ([5, 6, 8, 9, 9],)]
    assert values(spark, R.compact_pages(F.col("p")), rows, "p array<int>") == ["0,2,4-6", "", "3,2,1", "1,1-2", "7", "5-6,8-9,9"]


def test_chunks_of_a_total(spark):
    rows = [(9, 4), (5, 2), (0, 4), (0, 0), (4, 4)]
    assert values(spark, R.chunk_total(F.col("n"), F.col("k")), rows, "n int, k int") == [["0-3", "4-7", "8-8"], ["0-1", "2-3", "4-4"], [], [], ["0-3"]]
    with pytest.raises(Exception, match="greater than zero"):
        values(spark, R.chunk_total(F.col("n"), F.col("k")), [(3, 0)], "n int, k int")


def test_chunks_of_a_range(spark):
    rows = [("0,2,4-6", 2), ("0-5", 2), (",", 3)]
    assert values(spark, R.chunk_requested(F.col("r"), F.col("k")), rows, "r string, k int") == [["0,2", "4-5", "6"], ["0-1", "2-3", "4-5"], []]
    with pytest.raises(Exception, match="greater than zero"):
        values(spark, R.chunk_requested(F.col("r"), F.col("k")), [("1", 0)], "r string, k int")


def test_plan(spark):
    rows = [("", 9, 4, ".pdf"), (None, 9, 4, ".html"), (None, 3, 4, ".PDF"), ("0-1", 9, 4, ".pdf"), ("0,2,4-6", 9, 2, ".pdf"), (",", 9, 2, ".pdf"), ("1-3", 9, None, ".pdf")]
    got = values(spark, R.plan_chunks(F.col("r"), F.col("n"), F.col("k"), F.col("s")), rows, "r string, n int, k int, s string")
    assert got == [["0-3", "4-7", "8-8"], [None], [None], ["0-1"], ["0,2", "4-5", "6"], [","], ["1-3"]]


@hyp(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=12), min_size=1, max_size=20))
def test_parse_undoes_compact(spark, pages):
    rows = [(p,) for p in pages]
    text = values(spark, R.compact_pages(F.col("p")), rows, "p array<int>")
    assert [page_numbers(t) for t in text] == pages
    assert values(spark, R.parse_pages(F.col("t")), [(t,) for t in text], "t string") == pages


def test_spans_are_clipped_before_they_are_spelled_out(spark):
    r, n, k = F.col("r"), F.col("n"), F.col("k")
    rows = [("0-999999999", 7, 3), ("5-999999999999,0,1,2-900000000", 4, 2), ("9", 4, 2), ("1-2,3-4", 9, 9)]
    got = values(spark, R.chunk_spans(R.clip_spans(R.parse_spans(r), n), k), rows, "r string, n int, k int")
    assert got == [["0-2", "3-5", "6"], ["0-1", "2-3"], [], ["1-4"]]
    assert values(spark, R.parse_pages(r, n), rows, "r string, n int, k int") == [[*range(7)], [0, 1, 2, 3], [], [1, 2, 3, 4]]
    assert values(spark, R.past_end(R.parse_spans(r), n), rows, "r string, n int, k int") == [True, True, True, False]
    assert values(spark, R.span_pages(R.parse_spans(r)), rows[:1], "r string, n int, k int") == [1_000_000_000]
    assert page_numbers("0-999999999,1", 3) == [0, 1, 2, 1]


@hyp(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5)), min_size=1, max_size=6), st.integers(1, 5), st.integers(1, 12)), min_size=1, max_size=15))
def test_cutting_spans_is_cutting_pages(spark, cases):
    """Interval arithmetic against pages spelled out."""
    rows, want = [], []
    for spans, size, total in cases:
        pages = [p for a, n in spans for p in range(a, a + n + 1) if p < total]
        rows.append((",".join(f"{a}-{a + n}" for a, n in spans), size, total))
        want.append([pages[i : i + size] for i in range(0, len(pages), size)])
    got = values(spark, R.chunk_spans(R.clip_spans(R.parse_spans(F.col("r")), F.col("n")), F.col("k")), rows, "r string, k int, n int")
    assert [[page_numbers(c) for c in cut] for cut in got] == want


@pytest.mark.parametrize("bad", ["5-3", "-5", "5-", "1-2-3", "a", "1,b", "3--1"])
def test_what_raises_is_an_error_row(spark, bad):
    assert values(spark, R.range_error(F.col("r")), [(bad,), ("1, 2-3,,",), ("",), (None,)], "r string")[1:] == [None] * 3
    assert values(spark, R.range_error(F.col("r")), [(bad,)], "r string")[0]
