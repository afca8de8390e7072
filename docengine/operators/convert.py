"""Conversion of documents in columns, with a retry ladder inside the row.

Conversion is an Arrow UDF that returns a struct with an error field, so one bad
document, range or chunk size is a row and not a failed job. A PDF with a chunk size is
cut to parts, each a PDF of its own pages, which are dealt to tasks one by one;
one aggregate puts them together (``merge_chunks``). All else is converted where it is.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.predicates import ASSET_KEYS, LLM_WORDS, MEMORY_MESSAGES, MEMORY_NAME, is_out_of_memory
from ..functions.ranges import BAD_CHUNK, PAST_END, clip_spans, cut_spans, let, parse_spans, past_end, range_error, span_text
from ..functions.settings import OPTION_PREFIXES
from ..functions.text import decode64, suffix_or_default
from ..sources import formats
from .merge import batch_summary, groups_of, merge_chunks
from .passes import Resources, session_resources, task_device, written

MEMORY_WARNING = "CUDA out-of-memory during conversion; retrying on CPU."
LLM_WARNING = "LLM-assisted conversion failed; retrying without LLM enhancements."
NO_OCR = "force_ocr was asked for, but no optical backend is configured; the text layer was used."
NO_LLM = "use_llm was asked for, but no language-model backend is configured; it was left out."
NO_CONTENT = "ValueError: no content"
BAD_BASE64 = "Error: Incorrect padding or alphabet in base64 content"
#: Bytes of contents whose results are Python objects at once.
SLICE_BYTES = 4 << 20
RESULT = "struct<text:string,page_count:bigint,metadata:map<string,string>,warnings:array<string>,assets:string,error:string>"


IMAGE = re.compile(rb"\x89PNG|\xff\xd8\xff|GIF8|BM|II\*\x00|MM\x00\*|RIFF....WEBP", re.S)
ASSET_KEY_SET = frozenset(ASSET_KEYS)


class Backend(Protocol):
    """What converts one document. ``options`` hold the given options only."""

    def convert(self, content: bytes, suffix: str, options: dict, device: str | None) -> dict: ...


class TextBackend:
    """The parsers of this engine; no optics and no language model.

    ``page_numbers`` are the numbers of the pages of a part of a document, in their order.
    """

    def convert(self, content: bytes, suffix: str, options: dict, device: str | None) -> dict:
        warnings = [w for k, w in (("force_ocr", NO_OCR), ("use_llm", NO_LLM)) if options.get(k)]
        pages, metadata = formats.parse(content, suffix, warnings)
        shown = list(enumerate(pages))
        if options.get("page_numbers"):
            shown = list(zip(page_numbers(options["page_numbers"]), pages, strict=True))
        elif options.get("page_range"):
            shown = [(n, pages[n]) for n in page_numbers(options["page_range"], len(pages))]
            if any(last >= len(pages) for _, last in spans_of(options["page_range"])):
                warnings.append(PAST_END)
        images = [{"filename": t.rsplit("/", 1)[-1], "path": t} for _, blocks in shown for kind, _, t in blocks if kind == "image" and t]
        return {"text": formats.render(shown, options.get("output_format") or "markdown", bool(options.get("paginate_output"))), "page_count": len(shown), "metadata": metadata, "warnings": warnings, "assets": {"images": images} if images else {}}


_made: dict[tuple, Backend] = {}


class PerWorker:
    """A backend that each worker builds at its first use, by ``make(device, precision)``.

    Only ``make`` travels to the workers, never a model. The device is the accelerator that Spark has given to the task,
    where it has given one. Where the ladder asks for another device, a backend for that device is built and kept beside the first.
    """

    def __init__(self, make, device: str | None = None, precision: str | None = None):
        self.make, self.device, self.precision, self.key = make, device, precision, uuid.uuid4().hex

    @classmethod
    def of_session(cls, spark: SparkSession, make) -> PerWorker:
        """By the session's settings of device and precision."""
        own = session_resources(spark)
        return cls(make, own.device, own.precision)

    def convert(self, content: bytes, suffix: str, options: dict, device: str | None) -> dict:
        key = self.key, device or task_device(self.device)
        if key not in _made:
            _made[key] = self.make(key[1], self.precision)
        return _made[key].convert(content, suffix, options, device)


def coerce_result(got: dict) -> dict:
    """A backend's result with its ``extras`` (any payloads beside the text) told apart.

    Images by name become assets; what looks like assets joins the assets, other objects the metadata; all else is dropped.
    """
    metadata, assets = dict(got.get("metadata") or {}), {str(k): list(v) if isinstance(v, list | tuple) else v for k, v in (got.get("assets") or {}).items()}
    for extra in got.get("extras") or ():
        if not extra or not isinstance(extra, dict):
            continue
        images = {k: v for k, v in extra.items() if isinstance(v, bytes) and IMAGE.match(v)}
        for k, v in images.items():
            kind = formats.image_type(v)
            assets.setdefault("images", []).append({"filename": str(k), "content_base64": base64.b64encode(v).decode(), "media_type": kind})
        rest = {k: v for k, v in extra.items() if k not in images}
        if rest and (ASSET_KEY_SET & set(rest) or any(isinstance(v, dict | list | tuple) and "path" in str(v).lower() for v in rest.values())):
            assets |= json.loads(json.dumps({str(k): v for k, v in rest.items()}, default=str))
        else:
            metadata |= json.loads(json.dumps({str(k): v for k, v in rest.items()}, default=str))
    return got | {"metadata": metadata, "assets": assets}


def spans_of(text: str) -> list[tuple[int, int]]:
    """Spans of a range that ``range_error`` has passed, inside a worker."""
    parts = [p.split("-") for p in text.split(",") if p.strip()]
    return [(int(p[0]), int(p[-1])) for p in parts]


def page_numbers(text: str, total: int | None = None) -> list[int]:
    """Pages of a range inside a worker, of those a document of ``total`` pages has: spans are clipped before they are spelled out."""
    return [n for a, b in spans_of(text) for n in range(a, (b if total is None else min(b, total - 1)) + 1)]


def climb(backend: Backend, content: bytes, suffix: str, options: dict, again: bool = False, *, wait: bool = False, before: list[str] | None = None) -> dict:
    """Try a conversion; on memory failure once on the CPU, on model failure once without the model.

    ``again``: a memory failure after all that gets one more climb, as for contents given as bytes.
    ``wait``: a memory failure ends the climb, since another pass goes on with the row; that one
    gets the warnings of the first as ``before`` and runs on the CPU.

    The ladder's own warnings come before those of the result. Nothing outside
    of the call changes: the device is an argument, not a setting of the process.
    """
    warned = list(before or ())
    opts = {k: v for k, v in options.items() if v not in (None, False)}
    device = None
    if before is not None:
        warned.append(MEMORY_WARNING)
        device = "cpu"
        opts = _plain(opts) if LLM_WARNING in warned else opts
    while True:
        try:
            got = coerce_result(backend.convert(content, suffix, opts, device))
            return got | {"warnings": warned + list(got.get("warnings") or [])}
        except Exception as e:
            said = str(e).lower()
            memory = any(m in said for m in MEMORY_MESSAGES) or MEMORY_NAME in type(e).__name__.lower()
            if memory and not wait and MEMORY_WARNING not in warned:
                warned.append(MEMORY_WARNING)
                device = "cpu"
            elif opts.get("use_llm") and any(w in said for w in LLM_WORDS) and LLM_WARNING not in warned:
                warned.append(LLM_WARNING)
                opts = _plain(opts)
            elif again and memory and not wait:
                return climb(backend, content, suffix, options)
            else:
                return {"error": f"{type(e).__name__}: {e}", "warnings": warned}


def _plain(options: dict) -> dict:
    """Options without those of the language model."""
    return {k: v for k, v in options.items() if k not in ("use_llm", "llm_service") and not k.startswith(OPTION_PREFIXES)}


def _row(r: dict) -> dict:
    """A result as a row of RESULT."""
    metadata = [(str(k), v if isinstance(v, str) else json.dumps(v, default=str)) for k, v in (r.get("metadata") or {}).items()]
    return {"text": None if r.get("error") else str(r.get("text", "")), "page_count": r.get("page_count"), "metadata": metadata, "warnings": r["warnings"], "assets": json.dumps(r.get("assets") or {}, default=str), "error": r.get("error")}


_RESULT_ARROW = pa.struct([("text", pa.string()), ("page_count", pa.int64()), ("metadata", pa.map_(pa.string(), pa.string())), ("warnings", pa.list_(pa.string())), ("assets", pa.string()), ("error", pa.string())])


def _slices(contents: pa.Array):
    """(first, rows) of parts of a batch with about SLICE_BYTES of contents each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(contents), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    at = 0
    while at < len(contents):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield at, end - at
        at = end


def _convert_slices(backend: Backend, contents, suffixes, options, again: bool, wait: bool = False, befores=None):
    """Results of the rows of a batch, a list for each part of it."""
    for at, many in _slices(contents):
        rows = []
        for k, (c, s, o) in enumerate(zip(contents.slice(at, many), suffixes.slice(at, many).to_pylist(), options.slice(at, many).to_pylist(), strict=True)):
            o = dict(o or {})
            o |= dict(o.pop("extra", None) or {})
            c = c.as_py()
            rows.append(_row(climb(backend, c, s, o, again, wait=wait, before=None if befores is None else befores[at + k].as_py() or []) if c is not None else {"error": NO_CONTENT, "warnings": []}))
        yield rows


def _convert_all(backend: Backend, contents, suffixes, options, again: bool, wait: bool = False, befores=None) -> pa.Array:
    """Results of the rows of a batch. Only those of a part of it are Python objects at a time."""
    parts = [pa.array(rows, _RESULT_ARROW) for rows in _convert_slices(backend, contents, suffixes, options, again, wait, befores)]
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0] if parts else pa.array([], _RESULT_ARROW)


def converter(backend: Backend | None = None, again: bool = False):
    """An Arrow UDF (content, suffix, options) -> RESULT, in which assets are a JSON object."""
    backend = backend or TextBackend()

    def convert(contents: pa.Array, suffixes: pa.Array, options: pa.Array) -> pa.Array:
        return _convert_all(backend, contents, suffixes, options, again)

    convert.__annotations__ = {"contents": pa.Array, "suffixes": pa.Array, "options": pa.Array, "return": pa.Array}
    return F.arrow_udf(convert, RESULT)


def failure(backend: Backend | None = None):
    """An Arrow UDF (content, suffix, options) -> the error of a conversion, or null; texts do not leave the worker."""
    backend = backend or TextBackend()

    def tried(contents: pa.Array, suffixes: pa.Array, options: pa.Array) -> pa.Array:
        return pa.array([r["error"] for rows in _convert_slices(backend, contents, suffixes, options, False) for r in rows], pa.string())

    tried.__annotations__ = {"contents": pa.Array, "suffixes": pa.Array, "options": pa.Array, "return": pa.Array}
    return F.arrow_udf(tried, "string")


def _convert_stage(rows: DataFrame, backend: Backend, resources: Resources, again: bool, wait: bool, second: bool) -> DataFrame:
    """``rows`` (content, suffix, options and others) with a column result, by tasks with these resources.

    The content of a row stays only if the row waits for another pass.
    """

    def run(batches):
        for b in batches:
            done = _convert_all(backend, b.column("content"), b.column("suffix"), b.column("options"), again, wait, b.column("before") if second else None)
            yield pa.RecordBatch.from_arrays([*b.columns, done], [*b.schema.names, "result"])

    kind = rows.select(F.lit(None).cast(RESULT).alias("result")).schema["result"].dataType
    schema = StructType([*rows.schema.fields, StructField("result", kind)])
    return rows.mapInArrow(run, schema, profile=resources.profile(rows.sparkSession))


def convert_in_passes(docs: DataFrame, options: Column, *, backend: Backend, resources: Resources | None = None, content: str = "content", filename: str = "filename", again: bool = False) -> DataFrame:
    """doc_id, filename and the outputs of documents converted in one piece, in two passes.

    Tasks of the first have the accelerators of ``resources`` (by default the session's). A document that runs out
    of memory there is not tried on the CPU by a task that holds an accelerator: it is written with what it was
    warned of, and a second pass of tasks without one goes on with it. Rows and warnings are those of ``convert_documents``.
    """
    spark = docs.sparkSession
    resources = resources or session_resources(spark)
    rows = docs.withColumn("_options", options)
    rows = rows.select("doc_id", F.col(filename).alias("filename"), F.col(content).alias("content"), F.col("_options").alias("options"), suffix_or_default(F.col(filename)).alias("suffix"))
    rows = rows.withColumn("bad", range_error(_asked())).withColumn("options", F.col("options").withField("max_pages_per_chunk", F.lit(None).cast("int")))
    rows = rows.withColumn("content", F.when(F.col("bad").isNull(), F.col("content")))
    first = _convert_stage(rows, backend, resources, again, True, False)
    waits = F.coalesce(is_out_of_memory(F.col("result.error"), F.split("result.error", ":")[0]), F.lit(False))
    first = written(first.withColumn("waits", waits).withColumn("content", F.when(F.col("waits"), F.col("content"))), "pass")
    rest = first.where("waits").withColumn("before", F.col("result.warnings")).drop("result", "waits")
    second = _convert_stage(rest, backend, resources.on_cpu(), again, False, True).drop("before")
    done = first.where(~F.col("waits")).drop("waits").unionByName(second)
    error = F.coalesce(F.concat(F.lit("ValueError: "), "bad"), F.col("result.error"))
    return done.select("doc_id", F.col("filename").alias(filename), *_fields(), error.alias("error"))


_OUTLINE = "struct<total:int,top:int,objects:array<struct<at:bigint,size:bigint>>,pages:array<struct<no:int,needs:array<int>>>>"


def pdf_outline(content: Column) -> Column:
    """Pages of PDF bytes and the places in the file of what each needs; null where they are no PDF."""
    kind = pa.struct([("total", pa.int32()), ("top", pa.int32()), ("objects", pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64())]))), ("pages", pa.list_(pa.struct([("no", pa.int32()), ("needs", pa.list_(pa.int32()))])))])

    def outline(contents: pa.Array) -> pa.Array:
        out = []
        for c in contents:
            try:
                out.append(None if c.as_py() is None else formats.pdf_outline(c.as_py()))
            except (formats.UnsupportedDocument, ValueError, TypeError):
                out.append(None)
        return pa.array(out, kind)

    outline.__annotations__ = {"contents": pa.Array, "return": pa.Array}
    return F.arrow_udf(outline, _OUTLINE)(content)


def pdf_part(content: Column, outline: Column, spans: Column) -> Column:
    """A PDF of the pages of ``spans`` (clipped to the document) with the objects they need, put together from slices of the file.

    Bytes go through Latin-1 text, in which each byte is one sign. The part has a page tree of its
    own and no cross-reference table, which readers make anew.
    """

    def made(pages: Column) -> Column:
        needs = F.array_sort(F.array_distinct(F.flatten(F.transform(pages, lambda p: p["needs"]))))
        slices = F.transform(F.transform(needs, lambda i: F.get(outline["objects"], i)), lambda o: F.decode(F.substr(content, (o["at"] + 1).cast("int"), o["size"].cast("int")), "ISO-8859-1"))
        kids = F.array_join(F.transform(pages, lambda p: F.concat(p["no"].cast("string"), F.lit(" 0 R"))), " ")
        tree, root = ((outline["top"] + k).cast("string") for k in (1, 2))
        end = F.concat(F.lit("\n"), tree, F.lit(" 0 obj\n<< /Type /Pages /Count "), F.size(pages).cast("string"), F.lit(" /Kids ["), kids, F.lit("] >>\nendobj\n"), root, F.lit(" 0 obj\n<< /Type /Catalog /Pages "), tree, F.lit(" 0 R >>\nendobj\ntrailer << /Root "), root, F.lit(" 0 R >>\n%%EOF\n"))
        return F.encode(F.concat(F.lit("%PDF-1.7\n"), F.array_join(slices, "\n"), end), "ISO-8859-1")

    numbers = F.flatten(F.transform(spans, lambda s: F.sequence(s["first"].cast("int"), s["last"].cast("int"))))
    return let(F.transform(numbers, lambda n: F.get(outline["pages"], n)), made)


#: Columns of a result, in their order.
OUTPUTS = ("text", "page_count", "metadata", "warnings", "assets", "error")


def _asked(options: str = "options") -> Column:
    return F.nullif(F.col(f"{options}.page_range"), F.lit(""))


def _whole(rows: DataFrame, convert) -> DataFrame:
    """Documents in one piece, where they are: no shuffle. A bad range is the document's error."""
    given = F.col("options").withField("max_pages_per_chunk", F.lit(None).cast("int"))
    rows = rows.withColumn("result", convert(F.when(F.col("bad").isNull(), F.col("content")), F.col("suffix"), given))
    error = F.coalesce(F.concat(F.lit("ValueError: "), "bad"), F.col("result.error"))
    return rows.select("*", *_fields(), error.alias("error"))


def _fields() -> list[Column]:
    """The columns of a struct ``result`` but its error."""
    return [groups_of(F.col("result.assets")).alias(c) if c == "assets" else F.col(f"result.{c}") for c in OUTPUTS[:-1]]


def _in_parts(rows: DataFrame, convert) -> DataFrame:
    """PDF documents by parts of ``max_pages_per_chunk`` pages, each with its own pages' objects only.

    Parts are dealt to tasks one by one, so that a long document keeps many of them busy;
    equal rows are converted once. The content is read by one worker for the outline, and its parts by those that convert them.
    """
    key = ["doc_id", "filename", "k1", "k2", "k3"]
    rows = rows.withColumns({"k1": F.xxhash64("content"), "k2": F.xxhash64(F.lit(1), "content"), "k3": F.xxhash64(F.to_json("options"))})
    rows = rows.withColumn("outline", pdf_outline(F.when(F.col("bad").isNull(), F.col("content")))).withColumn("total", F.coalesce("outline.total", F.lit(0)))
    size, asked = F.col("options.max_pages_per_chunk"), _asked()
    rows = rows.withColumn("bad", F.coalesce("bad", F.when((size <= 0) & (F.col("total") > 0), BAD_CHUNK)))
    rows = rows.withColumn("asked", F.when(F.col("bad").isNull() & (F.col("total") > 0), parse_spans(asked)))
    all_pages = F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("total") - 1).cast("long").alias("last")))
    spans = F.when(asked.isNull(), all_pages).otherwise(clip_spans(F.col("asked"), F.col("total")))
    rows = rows.withColumn("spans", F.when(F.col("bad").isNull() & (F.col("total") > 0), spans))
    rows = rows.withColumn("past", F.coalesce(past_end(F.col("asked"), F.col("total")), F.lit(False)))
    rows = rows.withColumn("chunks", cut_spans(F.col("spans"), size)).withColumn("none", F.size("chunks") == 0)
    numbered = F.transform("chunks", lambda c, i: F.struct(i.alias("no"), c.alias("chunk")))
    one = F.array(F.struct(F.lit(0).alias("no"), F.lit(None).cast("array<struct<first:bigint,last:bigint>>").alias("chunk")))
    # no outer explode: Spark folds it away where no row is cut
    rows = rows.select("*", F.explode(F.when(F.size("chunks") > 0, numbered).otherwise(one)).alias("c")).select("*", F.col("c.no").alias("chunk_no"), F.col("c.chunk").alias("chunk"))
    part = F.when(F.col("chunk").isNull(), F.when(~F.coalesce("none", F.lit(False)), F.col("content"))).otherwise(pdf_part(F.col("content"), F.col("outline"), F.col("chunk")))
    rows = rows.select(*key, "chunk_no", "suffix", "options", "bad", "past", "none", F.when(F.col("chunk").isNotNull(), span_text(F.col("chunk"))).alias("numbers"), F.when(F.col("bad").isNull(), part).alias("part"))
    others = ("suffix", "options", "bad", "past", "none", "numbers", "part")
    # by a number of its own: partitions of few bytes must not be put together, since it is the work that is dealt
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, *key, "chunk_no").groupBy(*key, "chunk_no").agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in others))

    given = F.col("options").withField("page_range", F.when(F.col("numbers").isNull(), F.col("options.page_range"))).withField("max_pages_per_chunk", F.lit(None).cast("int")).withField("page_numbers", F.col("numbers"))
    done = dealt.withColumn("result", convert(F.col("part"), F.col("suffix"), given)).select(*key, "chunk_no", "copies", "bad", "past", "none", *_fields(), "result.error")
    # a range without any page of the document has no part to convert
    done = done.withColumn("error", F.coalesce(F.concat(F.lit("ValueError: "), "bad"), F.when(~F.coalesce("none", F.lit(False)), F.col("error"))))
    done = done.withColumn("page_count", F.when(F.col("none"), 0).otherwise(F.col("page_count")))
    failed = F.min_by("error", F.when(F.col("error").isNotNull(), F.col("chunk_no")))
    out = merge_chunks(done, key, more={"copies": F.max("copies"), "past": F.max("past"), "error": failed})
    of_ladder = lambda w: w.isin(MEMORY_WARNING, LLM_WARNING)
    told = F.concat(F.filter("warnings", of_ladder), F.filter("warnings", lambda w: ~of_ladder(w)), F.when(F.col("past"), F.array(F.lit(PAST_END))).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("warnings", told).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select("doc_id", "filename", *(F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in OUTPUTS[:-1]), "error")


def convert_documents(docs: DataFrame, options: Column, *, content: str = "content", filename: str = "filename", backend: Backend | None = None, merged: bool = True, again: bool = False) -> DataFrame:
    """``docs`` (doc_id, filename, content) converted: text, page_count, metadata, warnings, assets, error.

    PDF documents with a chunk size go by parts, of which one aggregate makes a document; all others are converted
    where they are, without a shuffle (if no chunk size is given, the plan has no other branch).
    A document fails as a whole with the error of its first failing part; a bad
    range or chunk size is its error too. Rows of equal doc_id are documents of their own. Pages past the end are left out with a warning.
    ``merged=False`` converts each document in one piece and lets further columns of ``docs`` pass; one that has the name of an output is replaced.
    """
    convert = converter(backend, again)
    rows = docs.withColumn("_options", options)
    more = [c for c in docs.columns if c not in (content, filename, *OUTPUTS, "doc_id")] if not merged else []
    rows = rows.select("doc_id", F.col(filename).alias("filename"), F.col(content).alias("content"), F.col("_options").alias("options"), suffix_or_default(F.col(filename)).alias("suffix"), *(F.col(c).alias(f"more_{c}") for c in more))
    size, asked = F.col("options.max_pages_per_chunk"), _asked()
    cut = size.isNotNull() & (F.lower("suffix") == ".pdf") if merged else F.lit(False)
    rows = rows.withColumn("bad", F.coalesce(F.when(cut & (size <= 0) & asked.isNotNull(), BAD_CHUNK), range_error(asked)))
    outputs = ["doc_id", F.col("filename").alias(filename), *OUTPUTS]
    whole = _whole(rows.where(~cut), convert).select(*outputs, *(F.col(f"more_{c}").alias(c) for c in more))
    return whole.unionByName(_in_parts(rows.where(cut), convert).select(*outputs)) if merged else whole


def result_json(results: DataFrame, out: str = "result") -> DataFrame:
    """``results`` with a text column ``out``: text, page count, metadata, warnings and assets, or the error, as one JSON object."""
    fields = [c for c in ("text", "page_count", "metadata", "warnings", "assets", "error") if c in results.columns]
    return results.withColumn(out, F.to_json(F.struct(*fields)))


def convert_batch(files: DataFrame, *, backend: Backend | None = None, options: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, summary) of rows (doc_pos, filename, content_base64[, options]).

    A missing name is ``document.pdf``, missing content is empty; malformed
    content is a failed row. Chunk sizes and the last try after a memory failure are those of single
    documents. Results keep doc_pos; order by it. Where the session names a shared folder, documents are converted once for both.
    """
    from .options import SCHEMA

    given = F.col("options") if "options" in files.columns else F.lit(None).cast(SCHEMA) if options is None else options
    rows = files.select(F.col("doc_pos").alias("doc_id"), F.coalesce(F.col("filename"), F.lit("document.pdf")).alias("filename"), decode64(F.coalesce(F.col("content_base64"), F.lit(""))).alias("content"), given.alias("given"))
    got = convert_documents(rows, F.col("given"), backend=backend, again=True)
    error = F.when(F.col("error") == NO_CONTENT, BAD_BASE64).otherwise(F.col("error"))
    results = written(got.select(F.col("doc_id").alias("doc_pos"), "filename", error.isNull().alias("success"), F.when(error.isNull(), F.col("text")).alias("content"), error.alias("error")), "batch")
    return results, batch_summary(results)
