"""Table functions for SQL: documents as rows of blocks or pages, and chunk plans."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.ranges import BAD_CHUNK
from ..sources import formats

#: Columns by output format: blocks, or one text for each page.
BLOCKS = {"page": int, "pos": int, "block_type": str, "level": int, "text": str, "error": str}
PAGES = {"page": int, "text": str, "error": str}


def _schema(columns: dict[str, type]) -> StructType:
    return StructType([StructField(n, IntegerType() if k is int else StringType()) for n, k in columns.items()])


class ConvertDocument:
    """``convert_blocks(content, filename, output_format)``: rows of one document, by its format.

    ``chunks`` and ``json`` give a row for each block, ``markdown`` and ``html`` one for each page; a document that
    cannot be read is one row with an error. The columns are told before the query runs, so the format must be a constant.
    """

    @staticmethod
    def analyze(content: AnalyzeArgument, filename: AnalyzeArgument, output_format: AnalyzeArgument) -> AnalyzeResult:
        kind = output_format.value
        if kind not in ("chunks", "html", "json", "markdown"):
            raise ValueError(f"output_format must be a constant: chunks, html, json or markdown, not {kind!r}")
        return AnalyzeResult(_schema(BLOCKS if kind in ("chunks", "json") else PAGES))

    def eval(self, content: bytes, filename: str, output_format: str):
        blocks = output_format in ("chunks", "json")
        try:
            if content is None:
                raise ValueError("no content")
            dot = (filename or "").rfind(".")
            pages, _ = formats.parse(bytes(content), filename[dot:] if dot > 0 else ".pdf")
        except Exception as e:
            yield (None,) * (5 if blocks else 2) + (f"{type(e).__name__}: {e}",)
            return
        for n, page in enumerate(pages):
            if blocks:
                for i, (kind, level, text) in enumerate(page):
                    yield n, i, kind, level, text, None
            else:
                yield n, formats.render([(n, page)], output_format, False), None


class PlanChunks:
    """``plan_chunks(total, size)``: (chunk_no, page_range) of the chunks of so many pages."""

    def eval(self, total: int, size: int):
        if total is None or size is None:
            return
        if total > 0 and size <= 0:
            raise ValueError(BAD_CHUNK)
        for k, a in enumerate(range(0, total, size) if total > 0 else ()):
            yield k, f"{a}-{min(a + size, total) - 1}"


def register(spark: SparkSession) -> None:
    spark.udtf.register("plan_chunks", udtf(PlanChunks, returnType="chunk_no int, page_range string"))
    spark.udtf.register("convert_blocks", udtf(ConvertDocument))
