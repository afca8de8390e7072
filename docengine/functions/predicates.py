"""Predicates that steer conversion: failures, assets, images, chunking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words by which failures and asset groups are told.
MEMORY_MESSAGES = ["cuda out of memory", "hip out of memory"]
MEMORY_NAME = "outofmemory"
LLM_WORDS = ["llm", "ollama", "openai", "anthropic", "claude", "gemini", "google"]
ASSET_KEYS = ["artifacts", "assets", "attachments", "files", "images", "paths"]


def is_out_of_memory(message: Column, kind: Column | None = None) -> Column:
    low = F.lower(message)
    found = F.contains(low, F.lit(MEMORY_MESSAGES[0])) | F.contains(low, F.lit(MEMORY_MESSAGES[1]))
    return found if kind is None else found | F.contains(F.lower(kind), F.lit(MEMORY_NAME))


def is_llm_failure(message: Column) -> Column:
    return F.lower(message).rlike("|".join(LLM_WORDS))


def looks_like_assets(payload: Column) -> Column:
    """Whether a JSON object is a set of assets, by a key or by a container that mentions a path."""
    entries = F.from_json(payload, "map<string,string>")
    by_key = F.arrays_overlap(F.map_keys(entries), F.array(*map(F.lit, ASSET_KEYS)))
    holds = F.exists(F.map_values(entries), lambda v: v.rlike(r"^\s*[\[{]") & F.contains(F.lower(v), F.lit("path")))
    return F.coalesce(by_key | holds, F.lit(False))


def is_image(content: Column) -> Column:
    """By magic bytes of the formats in the image table."""
    head = F.hex(F.substring(content, 1, 12))
    return head.rlike("^(89504E47|FFD8FF|47494638|424D|49492A00|4D4D002A|52494646.{8}57454250)")


def is_valid_asset(filename: Column, content_base64: Column) -> Column:
    return F.coalesce((filename != "") & (content_base64 != ""), F.lit(False))
