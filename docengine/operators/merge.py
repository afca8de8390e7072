"""Ordered merge of a document's chunks, and batch summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_texts

#: Asset groups by name: lists of assets (of the fields of ASSET), objects or plain values.
GROUPS = "map<string,variant>"
ASSET = "struct<filename:string,path:string,content_base64:string,media_type:string>"
#: Schema of chunk rows.
CHUNK = f"doc_id long, chunk_no int, text string, page_count long, metadata map<string,string>, warnings array<string>, assets {GROUPS}"


def last_wins(maps: Column) -> Column:
    """One map of an array of maps; of a key, the last map that has it wins, nulls too."""
    return F.aggregate(maps, F.create_map().cast("map<string,string>"), lambda a, m: F.map_zip_with(a, m, lambda k, x, y: F.when(F.map_contains_key(m, k), y).otherwise(x)))


def groups_of(json_text: Column) -> Column:
    """Assets, a JSON object of groups, as map<string,variant>; null is no group."""
    return F.variant_get(F.parse_json(F.coalesce(json_text, F.lit("{}"))), "$", GROUPS)


def fold_assets(groups: Column) -> Column:
    """One map of an array of maps of asset groups, in order.

    Of a group, lists are put end to end, objects are updated (a later value of a key wins), and a value of
    another kind replaces what was there.
    """
    a_list = lambda v: F.schema_of_variant(v).startswith("ARRAY")
    an_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")

    def together(x: Column, y: Column) -> Column:
        lists = F.to_variant_object(F.concat(x.cast("array<variant>"), y.cast("array<variant>")))
        objects = F.to_variant_object(F.map_zip_with(x.cast(GROUPS), y.cast(GROUPS), lambda k, old, new: F.coalesce(new, old)))
        return F.when(a_list(x) & a_list(y), lists).when(an_object(x) & an_object(y), objects).otherwise(y)

    both = lambda x, y: F.when(y.isNull(), x).when(x.isNull(), y).otherwise(together(x, y))
    return F.aggregate(groups, groups_of(F.lit("{}")), lambda acc, m: F.map_zip_with(acc, m, lambda k, x, y: both(x, y)))


def merged_rows(rows: Column) -> dict[str, Column]:
    """What an array of chunk structs, in order, makes together: text, page_count, metadata, warnings and assets by name.

    Page counts add up and are null if no chunk has one.
    """
    each = lambda c, d: F.transform(rows, lambda r: F.coalesce(r[c], d))
    pages = F.aggregate(rows, F.lit(None).cast("long"), lambda n, r: F.when(n.isNull(), r["page_count"]).otherwise(n + F.coalesce(r["page_count"], F.lit(0))))
    return {
        "text": join_texts(each("text", F.lit(""))),
        "page_count": pages,
        "metadata": last_wins(each("metadata", F.create_map().cast("map<string,string>"))),
        "warnings": F.flatten(each("warnings", F.array().cast("array<string>"))),
        "assets": fold_assets(each("assets", groups_of(F.lit(None)))),
    }


def merge_chunks(chunks: DataFrame, key: str | list[str] = "doc_id", order: str = "chunk_no", more: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: text, page_count, metadata, warnings and assets of its chunks in order.

    ``more`` are further aggregates by name, made in the same pass. Chunks of a document
    are few; documents are spread by key, and one document's rows meet once.
    """
    keys = [key] if isinstance(key, str) else key
    # maps have no order: the sort looks at the chunk number alone
    rows = F.array_sort(F.collect_list(F.struct(order, "text", "page_count", "metadata", "warnings", "assets")), lambda a, b: a[order] - b[order])
    got = chunks.groupBy(*keys).agg(rows.alias("rows"), *(c.alias(k) for k, c in (more or {}).items()))
    return got.select(*keys, *(c.alias(n) for n, c in merged_rows(F.col("rows")).items()), *(more or {}))


def batch_summary(results: DataFrame) -> DataFrame:
    """total, successful, failed; zeros for an empty batch."""
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("successful")).select("total", "successful", (F.col("total") - F.col("successful")).alias("failed"))
