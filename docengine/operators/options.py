"""Conversion options as one nullable struct: an omitted option is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.settings import OPTION_PREFIXES

SCHEMA = "struct<output_format:string,page_range:string,max_pages_per_chunk:int,force_ocr:boolean,paginate_output:boolean,use_llm:boolean,llm_service:string,extra:map<string,string>>"
FORMATS = ["chunks", "html", "json", "markdown"]


def _col(x, kind: str) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast(kind)


def build_options(output_format="markdown", page_range=None, force_ocr=False, paginate_output=False, use_llm=False, max_pages_per_chunk=None, llm: Column | None = None) -> Column:
    """The option struct. Empty ranges and false flags are omitted; a chunk size of 0 is kept.

    ``llm``, a map of service options, is merged only where ``use_llm`` is true.
    """
    flag = lambda x: F.when(_col(x, "boolean"), F.lit(True))
    extra = F.when(_col(use_llm, "boolean"), llm) if llm is not None else F.lit(None)
    extra = extra.cast("map<string,string>")
    return F.struct(
        _col(output_format, "string").alias("output_format"),
        F.nullif(_col(page_range, "string"), F.lit("")).alias("page_range"),
        _col(max_pages_per_chunk, "int").alias("max_pages_per_chunk"),
        flag(force_ocr).alias("force_ocr"),
        flag(paginate_output).alias("paginate_output"),
        flag(use_llm).alias("use_llm"),
        F.try_element_at(extra, F.lit("llm_service")).alias("llm_service"),
        F.map_filter(extra, lambda k, v: k != "llm_service").alias("extra"),
    )


def example_options(page_range=None, force_ocr=False, use_llm=False, output_format="markdown", *, max_pages_per_chunk=4, paginate_output=True, llm: Column | None = None) -> Column:
    """The profile for files from a command line: pages are told apart, four a chunk."""
    return build_options(output_format, page_range, force_ocr, paginate_output, use_llm, max_pages_per_chunk, llm)


def without_chunking(options: Column) -> Column:
    return options.withField("max_pages_per_chunk", F.lit(None).cast("int"))


def without_llm(options: Column) -> Column:
    keep = lambda k, v: ~k.rlike(f"^({'|'.join(OPTION_PREFIXES)})")
    return options.withField("use_llm", F.lit(None).cast("boolean")).withField("llm_service", F.lit(None).cast("string")).withField("extra", F.map_filter(options["extra"], keep))
