"""Page-range algebra as column expressions: parse, clip, cut and write ranges.

A range is text such as ``0,5-10,20``: zero-based pages and inclusive spans, in
the order asked for, duplicates kept. It is held as spans (first, last) and is
never spelled out page by page before it is clipped to a document, so that
``0-999999999`` costs no more than ``0-9``. Everything here stays inside Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NON_NEGATIVE = "page_range values must be non-negative."
DESCENDING = "page_range end must be greater than or equal to start."
BAD_CHUNK = "max_pages_per_chunk must be greater than zero."
INVALID = "page_range must hold page numbers and spans of them."
PAST_END = "page_range asks for pages past the end of the document; they were left out."


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: a lambda would work an outer expression out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(page_range: Column) -> Column:
    return F.filter(F.transform(F.split(page_range, ","), lambda x: F.trim(x)), lambda x: x != "")


def range_error(page_range: Column) -> Column:
    """What is wrong with a range, or null: for plans in which a bad range is a row and no failure."""
    number = r"\d{1,18}"
    end = lambda x: F.regexp_extract(x, rf"-\s*({number})$", 1).try_cast("long")
    start = lambda x: F.regexp_extract(x, rf"^({number})", 1).try_cast("long")
    return let(
        _parts(page_range),
        lambda parts: F.when(F.exists(parts, lambda x: x.rlike(rf"^{number}\s*-\s*-\s*{number}$")), NON_NEGATIVE)
        .when(F.exists(parts, lambda x: ~x.rlike(rf"^{number}(\s*-\s*{number})?$")), INVALID)
        .when(F.exists(parts, lambda x: F.coalesce(end(x) < start(x), F.lit(False))), DESCENDING),
    )


def runs(rows: DataFrame, key: str, page: str) -> DataFrame:
    """(key, first, last) of the runs of consecutive values of a key, whatever their number: gaps by lag, runs by a running count."""
    w = Window.partitionBy(key).orderBy(page)
    gap = F.when(F.col(page) == F.lag(page).over(w) + 1, 0).otherwise(1)
    marked = rows.select(key, page, gap.alias("gap")).select(key, page, F.sum("gap").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return marked.groupBy(key, "run").agg(F.min(page).alias("first"), F.max(page).alias("last")).drop("run")


def _span(first: Column, last: Column) -> Column:
    return F.struct(first.cast("long").alias("first"), last.cast("long").alias("last"))


def _joined(spans: Column) -> Column:
    """Spans of which each goes on where the last one ended, as one."""

    def whole(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["first"] != F.get(s, i - 1)["last"] + 1))
        return let(begins, lambda b: F.transform(b, lambda i, k: _span(F.get(s, i)["first"], F.get(s, F.coalesce(F.get(b, k + 1), F.size(s)) - 1)["last"])))

    return let(spans, lambda s: F.when(F.size(s) <= 1, s).otherwise(whole(s)))


def parse_spans(page_range: Column) -> Column:
    """Spans of a range in its order, those that go on from each other as one; malformed ranges raise."""

    def span(x: Column) -> Column:
        dash = F.instr(x, "-")
        first = F.trim(F.substring_index(x, "-", 1)).cast("long")
        last = F.trim(F.substr(x, dash + F.lit(1))).cast("long")
        two = F.when(last < 0, F.raise_error(F.lit(NON_NEGATIVE))).when(last < first, F.raise_error(F.lit(DESCENDING))).otherwise(_span(first, last))
        return F.when(dash > 0, two).otherwise(_span(x.cast("long"), x.cast("long")))

    return _joined(F.transform(_parts(page_range), span))


def clip_spans(spans: Column, total: Column) -> Column:
    """What of the spans lies in a document of ``total`` pages."""
    return F.transform(F.filter(spans, lambda s: s["first"] < total), lambda s: _span(s["first"], F.least(s["last"], total.cast("long") - 1)))


def past_end(spans: Column, total: Column) -> Column:
    """Whether spans ask for pages that a document of ``total`` pages does not have."""
    return F.exists(spans, lambda s: s["last"] >= total)


def span_pages(spans: Column) -> Column:
    """Number of pages of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def cut_spans(spans: Column, size: Column) -> Column:
    """Arrays of spans of ``size`` pages each, the last perhaps less; a piece's place is the sum of the lengths before it."""

    def placed(s: Column) -> Column:
        kind = "struct<at:bigint,out:array<struct<first:bigint,last:bigint,at:bigint>>>"
        start = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(kind)
        put = lambda acc, x: F.struct((acc["at"] + x["last"] - x["first"] + 1).alias("at"), F.array_append(acc["out"], F.struct(x["first"].alias("first"), x["last"].alias("last"), acc["at"].alias("at"))).alias("out"))
        return F.aggregate(s, start, put)

    def chunk(p: Column, k: Column) -> Column:
        low, high = k * size, (k + 1) * size - 1
        here = F.filter(p["out"], lambda x: (x["at"] <= high) & (x["at"] + x["last"] - x["first"] >= low))
        return F.transform(here, lambda x: _span(x["first"] + F.greatest(F.lit(0), low - x["at"]), F.least(x["last"], x["first"] + high - x["at"])))

    none = F.array().cast("array<array<struct<first:bigint,last:bigint>>>")
    return let(placed(spans), lambda p: F.when(p["at"] <= 0, none).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.expr("0L") + ((p["at"] - 1) / size).cast("long")), lambda k: chunk(p, k))))


def span_text(spans: Column) -> Column:
    """The range text of spans."""
    label = lambda s: F.when(s["first"] == s["last"], s["first"].cast("string")).otherwise(F.concat(s["first"].cast("string"), F.lit("-"), s["last"].cast("string")))
    return F.array_join(F.transform(spans, label), ",")


def parse_pages(page_range: Column, total: Column | None = None) -> Column:
    """Page numbers of a range as array<int>, of those a document of ``total`` pages has if it is given; malformed ranges raise."""
    spans = parse_spans(page_range) if total is None else clip_spans(parse_spans(page_range), total)
    return F.flatten(F.transform(spans, lambda s: F.sequence(s["first"].cast("int"), s["last"].cast("int"))))


def compact_pages(pages: Column) -> Column:
    """The range text of page numbers in their order: ascending runs become spans."""
    return span_text(_joined(F.transform(pages, lambda p: _span(p, p))))


def chunk_total(total: Column, size: Column) -> Column:
    """Ranges that cut ``total`` pages to chunks; no pages give no chunks, whatever the size."""
    bounds = F.transform(F.sequence(F.lit(0), total - 1, size), lambda s: F.concat(s.cast("string"), F.lit("-"), F.least(s + size - 1, total - 1).cast("string")))
    return F.when(total <= 0, F.array().cast("array<string>")).when(size <= 0, F.raise_error(F.lit(BAD_CHUNK))).otherwise(bounds)


def chunk_spans(spans: Column, size: Column) -> Column:
    """Ranges of ``size`` pages each that spans are cut to."""
    return F.when(size <= 0, F.raise_error(F.lit(BAD_CHUNK))).otherwise(F.transform(cut_spans(spans, size), span_text))


def chunk_requested(page_range: Column, size: Column) -> Column:
    """Ranges of ``size`` pages each that a requested range is cut to."""
    return chunk_spans(parse_spans(page_range), size)


def plan_chunks(page_range: Column, total: Column, size: Column, suffix: Column) -> Column:
    """The page ranges that a document is converted by; a null entry is the whole document.

    Only ``.pdf`` documents with a chunk size are cut. A requested range is clipped to ``total``
    pages where that is above 0. A plan of one chunk keeps the range as it was written.
    """
    asked = F.nullif(page_range, F.lit(""))
    whole = F.array(asked)
    spans = let(parse_spans(asked), lambda s: F.when(total > 0, clip_spans(s, total)).otherwise(s))
    by_range = let(chunk_spans(spans, size), lambda c: F.when(F.size(c) <= 1, whole).otherwise(c))
    by_total = F.when(total <= size, whole).otherwise(chunk_total(total, size))
    return F.when(size.isNull() | (F.lower(suffix) != ".pdf"), whole).otherwise(F.when(asked.isNotNull(), by_range).otherwise(by_total))
