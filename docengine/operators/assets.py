"""Assets: rows of assets, and names that are safe to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_valid_asset
from .merge import ASSET


def asset_rows(results: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, asset_group, pos, filename, content_base64, media_type) of the valid assets; groups that are no lists hold none."""
    groups = results.select(key, F.explode("assets").alias("asset_group", "items"))
    rows = groups.select(key, "asset_group", F.posexplode(F.try_variant_get("items", "$", f"array<{ASSET}>")).alias("pos", "item"))
    return rows.where(is_valid_asset(F.col("item.filename"), F.col("item.content_base64"))).select(key, "asset_group", "pos", "item.filename", "item.content_base64", "item.media_type")


def is_safe_name(filename: Column) -> Column:
    """Relative, not empty, and never above the folder it is written to."""
    parts = F.split(F.regexp_replace(filename, r"\\", "/"), "/")
    depth = F.aggregate(parts, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda a, p: F.struct((a["d"] + F.when(p == "..", -1).when(p.isin("", "."), 0).otherwise(1)).alias("d"), F.least(a["low"], a["d"] + F.when(p == "..", -1).otherwise(0)).alias("low")))
    return F.coalesce((F.trim(filename) != "") & ~filename.startswith("/") & ~filename.rlike("^[A-Za-z]:") & (depth["low"] >= 0) & (depth["d"] > 0), F.lit(False))
