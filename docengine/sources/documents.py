"""Sources of documents: files, binary and base64 columns, settings files; and sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode64, suffix_or_default
from .sink import write_files

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def read_files(spark: SparkSession, path: str, pattern: str | None = None, largest: int | None = None) -> DataFrame:
    """(doc_id, path, filename, suffix, length, content) of the files of a folder.

    A file's name is its path below the folder. Names and sizes come from the listing: a ``pattern`` of names and the
    ``largest`` size reach it, and a query that does not ask for contents opens no file.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    rows = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    rows = rows.where(F.col("length") <= largest) if largest is not None else rows
    base = F.element_at(F.split("path", "/"), -1)
    folder = F.lit("/" + path.split("://", 1)[-1].split(":/", 1)[-1].strip("/") + "/")
    at = F.instr(F.col("path"), folder)
    name = F.when(at > 0, F.substr(F.col("path"), at + F.length(folder))).otherwise(base)
    return rows.select(F.xxhash64("path").alias("doc_id"), "path", name.alias("filename"), suffix_or_default(name).alias("suffix"), "length", "content")


def from_base64(rows: DataFrame, column: str = "content_base64") -> DataFrame:
    """``rows`` with a binary column ``content``; null where the text is malformed."""
    return rows.withColumn("content", decode64(F.col(column)))


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of a settings file: blank lines, comments and lines without = are skipped."""
    line = F.trim("value")
    rows = spark.read.text(path).where((line != "") & ~line.startswith("#") & F.contains(line, F.lit("=")))
    clean = lambda c: F.regexp_replace(F.trim(c), "^[\"']+|[\"']+$", "")
    parts = F.split(line, "=", 2)
    return rows.select(F.trim(parts[0]).alias("name"), clean(parts[1]).alias("value"))


def write_texts(results: DataFrame, folder: str, *, name: str = "filename", text: str = "text", assets: bool = True) -> int:
    """One file per document, and its assets, under a folder that all executors share (``sink.write_files``).

    A text keeps its document's path with the suffix of its format; assets lie in a
    folder of the document's own. Names that are empty, lead out of the folder or
    are those of two files are refused, and then nothing is written. Returns the number of files.
    """
    kept = ["assets"] if assets and "assets" in results.columns else []
    before = set(_files(folder))
    write_files(results.select(F.col(name).alias("filename"), F.col(text).alias("text"), *kept, *(["error"] if "error" in results.columns else [])), folder)
    return len(set(_files(folder)) - before)


def _files(folder: str) -> list[str]:
    """Files below a folder but those that begin with an underscore."""
    return [os.path.join(d, n) for d, _, names in os.walk(folder) if not os.path.relpath(d, folder).startswith("_") for n in names]
