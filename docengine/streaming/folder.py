"""A folder as a stream of documents: conversion has no state, so each file is done once it is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import suffix_or_default
from ..operators.convert import converter
from ..sources.documents import BINARY_FILE


def stream_folder(spark: SparkSession, path: str, pattern: str = "*", files_per_trigger: int = 100) -> DataFrame:
    rows = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return rows.select("path", name.alias("filename"), suffix_or_default(name).alias("suffix"), "content")


def convert_stream(docs: DataFrame, options: Column) -> DataFrame:
    result = converter()(F.col("content"), F.col("suffix"), options)
    return docs.select("path", "filename", result.alias("result")).select("path", "filename", "result.*")


def start(converted: DataFrame, target: str, checkpoint: str, once: bool = True):
    """Write a converted stream to Parquet, exactly once by its checkpoint."""
    writer = converted.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
