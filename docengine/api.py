"""The engine's calls: one document, many documents, a batch, status, and a command line."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.settings import llm_options
from .functions.text import suffix_or_default
from .operators.convert import Backend, TextBackend, convert_batch, convert_documents, converter, failure, result_json
from .operators.options import build_options, example_options
from .sources.documents import from_base64, read_files, read_settings
from .sources.sink import check_names, read_errors, write_files

#: Lines of a settings file that are read at most.
MOST_SETTINGS = 1000
READY, FAILED = "The converter is ready.", "The converter could not be initialised."


def convert(docs: DataFrame, *, backend: Backend | None = None, **options) -> DataFrame:
    """Text of ``docs`` (doc_id, filename, content): doc_id, filename, text, error."""
    return convert_result(docs, backend=backend, **options).select("doc_id", "filename", "text", "error")


def convert_result(docs: DataFrame, *, backend: Backend | None = None, again: bool = False, **options) -> DataFrame:
    """Text, page_count, metadata, warnings and assets of ``docs``, or an error."""
    return convert_documents(docs, build_options(**options), backend=backend, again=again)


def convert_json(docs: DataFrame, *, backend: Backend | None = None, **options) -> DataFrame:
    """doc_id, filename and the whole result as one JSON text."""
    return result_json(convert_result(docs, backend=backend, **options)).select("doc_id", "filename", "result")


def convert_path(spark: SparkSession, path: str, pattern: str | None = None, *, backend: Backend | None = None, **options) -> DataFrame:
    return convert_result(read_files(spark, path, pattern), backend=backend, **options)


def convert_content(docs: DataFrame, *, backend: Backend | None = None, **options) -> DataFrame:
    """Like ``convert`` for a column content_base64. A memory failure gets one more try by the ladder."""
    return convert_result(from_base64(docs), backend=backend, again=True, **options).select("doc_id", "filename", "text", "error")


def batch(files: DataFrame, *, backend: Backend | None = None) -> tuple[DataFrame, DataFrame]:
    return convert_batch(files, backend=backend)


def status(spark: SparkSession, backend: Backend | None = None, probe: DataFrame | None = None) -> DataFrame:
    """One row: initialized, status, message. Tries a tiny document here, or those of ``probe`` (doc_id, filename, content) in the workers.

    With ``probe`` it is ready if no document fails, and the row stays part of the query: nothing is collected.
    """
    row = lambda ok: [ok.alias("initialized"), F.when(ok, "ready").otherwise("failed").alias("status"), F.when(ok, READY).otherwise(FAILED).alias("message")]
    if probe is not None:
        tried = probe.withColumn("_options", build_options()).select(failure(backend)("content", suffix_or_default(F.col("filename")), "_options").alias("error"))
        return tried.agg((F.count_if(F.col("error").isNotNull()) == 0).alias("ok")).select(*row(F.col("ok")))
    try:
        (backend or TextBackend()).convert(b"<p>x</p>", ".html", {}, None)
        ok = True
    except Exception:
        ok = False
    return spark.range(1).select(*row(F.lit(ok)))


def require_ready(spark: SparkSession, backend: Backend | None = None) -> None:
    row = status(spark, backend).first()
    if not row["initialized"]:
        raise RuntimeError(row["message"])


def register(spark: SparkSession) -> None:
    """SQL: the function convert_document(content, suffix, options), the table functions convert_blocks and plan_chunks."""
    from .operators import tables

    spark.udf.register("convert_document", converter())
    tables.register(spark)


def settings_options(spark: SparkSession, path: str | None) -> Column | None:
    """The options map that a settings file gives, for ``build_options(llm=...)``: a few lines, read by the driver."""
    if path is None:
        return None
    rows = read_settings(spark, path).limit(MOST_SETTINGS).collect()
    return llm_options(F.create_map(*(F.lit(x) for r in {r["name"]: r["value"] for r in rows}.items() for x in r)).cast("map<string,string>"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docengine", description="Convert the documents of a folder to text files.")
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--pattern")
    p.add_argument("--output-format", default="markdown")
    p.add_argument("--page-range")
    p.add_argument("--max-pages-per-chunk", type=int, default=4)
    p.add_argument("--force-ocr", action="store_true")
    p.add_argument("--use-llm", action="store_true")
    p.add_argument("--settings", help="file of NAME=value lines for the language-model service")
    p.add_argument("--paginate", action=argparse.BooleanOptionalAction, default=True)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("docengine").getOrCreate()
    docs = read_files(spark, a.source, a.pattern)
    check_names(docs)
    options = example_options(a.page_range, a.force_ocr, a.use_llm, a.output_format, max_pages_per_chunk=a.max_pages_per_chunk, paginate_output=a.paginate, llm=settings_options(spark, a.settings))
    got = convert_documents(docs, options)
    write_files(got, a.target, a.output_format)
    for r in read_errors(spark, a.target).toLocalIterator():
        print(f"{r['filename']}: {r['error']}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
