"""The registered queries over the driver's tables, with the same in SQL.

Each pair shows one operator. Tables are read whole; the lines of a document
stand for its pages where pages are needed.
"""

from __future__ import annotations

import io
import json
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import api
from ..functions import predicates, ranges, settings, text
from ..operators import assets, convert, merge, options, passes
from ..sources import sink

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- conversion of pages -------------------------------------------------------


def _blocks_sql() -> str:
    """The shown blocks of a page as a list in page order, of what DuckDB's regular expressions can do.

    Parts that are not shown go; block tags part blocks, headings keep their sign in front; line breaks stay, other white space is one space.
    """
    text = "html"
    for part in ("<!--.*?-->", *(f"<{t}\\b.*?</{t}\\s*>" for t in ("title", "script", "style", "nav", "footer"))):
        text = f"regexp_replace({text}, '(?is){part}', '', 'g')"
    for tag, to in (("<h1[^>]*>", "chr(1) || '# '"), ("</?(?:p|h1|li|ul|div|article|body)\\b[^>]*>", "chr(1)"), ("<br\\b[^>]*>", "chr(11)"), ("</?(?:b|strong)\\b[^>]*>", "'**'"), ("<[a-z/!][^>]*>", "''")):
        text = f"regexp_replace({text}, '(?is){tag}', {to}, 'g')"
    for name, sign in (("copy", "©"), ("middot", "·"), ("nbsp", " "), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{sign}')"
    line = r"trim(regexp_replace(y, '[ \t\r\n]+', ' ', 'g'))"
    block = f"trim(array_to_string(list_transform(string_split(x, chr(11)), lambda y: {line}), chr(10)), ' ' || chr(10))"
    return f"list_filter(list_transform(string_split({text}, chr(1)), lambda x: {block}), lambda x: x <> '' AND x <> '#')"


_BLOCKS = _blocks_sql()
_MARKDOWN = f"array_to_string({_BLOCKS}, chr(10) || chr(10))"


def _whole_markdown_sql() -> str:
    """Markdown of a page with headings of all six levels, signs of list items and lines of code: a mark in front of a block tells its kind.

    Texts of noscript and template are shown, parts that are never closed too.
    """
    text = "html"
    script, style, title, nav, footer = (f"<{t}(?:[\\s/][^>]*[^/>]|\\s*)>.*?</{t}\\s*>" for t in ("script", "style", "title", "nav", "footer"))
    for part in (f"<!--.*?-->|{script}|{style}|{title}", nav, footer):
        text = f"regexp_replace({text}, '(?is){part}', '', 'g')"
    marks = {chr(2): "- ", **{chr(13 + n): "#" * n + " " for n in range(1, 7)}}
    tags = [("<li\\b[^>]*>", "chr(1) || chr(2)"), *((f"<h{n}\\b[^>]*>", f"chr(1) || chr({13 + n})") for n in range(1, 7)), ("<pre\\b[^>]*>", "chr(1) || chr(20)")]
    tags += [("</?(?:p|h[1-6]|li|ul|ol|div|article|section|main|blockquote|header|aside|form|body|hr|pre)\\b[^>]*>", "chr(1)"), ("<br\\b[^>]*>", "chr(11)"), ("</?(?:b|strong)\\b[^>]*>", "chr(21)"), ("<(?:[a-z/][^>]*|!(?:-?[^->][^>]*)?)>", "''")]
    for tag, to in tags:
        text = f"regexp_replace({text}, '(?is){tag}', {to}, 'g')"
    for name, sign in (("copy", "©"), ("middot", "·"), ("nbsp", " "), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{sign}')"
    line = r"trim(regexp_replace(y, '[ \t\r\n]+', ' ', 'g'))"
    block = f"trim(array_to_string(list_transform(string_split(replace(x, chr(21), '**'), chr(11)), lambda y: {line}), chr(10)), ' ' || chr(10))"
    code = "chr(20) || trim(replace(replace(x[2:], chr(21), ''), chr(11), chr(10)), chr(10))"
    shown = f"list_filter(list_transform(string_split({text}, chr(1)), lambda x: CASE WHEN starts_with(x, chr(20)) THEN {code} ELSE {block} END), lambda x: NOT regexp_full_match(x, '[\\x02\\x0e-\\x14]?'))"
    kind = "x"
    for mark, sign in marks.items():
        kind = f"regexp_replace({kind}, '^\\x{ord(mark):02x}[ \\n]*', '{sign}')"
    return f"array_to_string(list_transform({shown}, lambda x: CASE WHEN starts_with(x, chr(20)) THEN '```' || chr(10) || x[2:] || chr(10) || '```' ELSE {kind} END), chr(10) || chr(10))"


@_query(f"SELECT page_id, {_whole_markdown_sql()} AS markdown FROM pages")
def html_to_markdown(spark, sf):
    return api.convert(_html_docs(spark, sf)).select(F.col("doc_id").alias("page_id"), F.col("text").alias("markdown"))


@_query(f"SELECT page_id, array_to_string(list_transform({_BLOCKS}, lambda x: regexp_replace(replace(x, '**', ''), '^# ', '')), chr(10)) AS text FROM pages")
def html_to_text(spark, sf):
    got = convert.convert_documents(_html_docs(spark, sf), options.build_options("json"))
    blocks = F.flatten(F.transform(F.from_json("text", "children array<struct<children array<struct<block_type string, text string>>>>")["children"], lambda p: p["children"]))
    shown = F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")
    return got.select(F.col("doc_id").alias("page_id"), F.replace(shown, F.lit("**"), F.lit("")).alias("text"))


@_query(f"SELECT page_id, (generate_subscripts(l, 1) - 1)::INT AS pos, CASE WHEN starts_with(x, '# ') THEN 'heading' ELSE 'paragraph' END AS block_type, regexp_replace(x, '^# ', '') AS text FROM (SELECT page_id, l, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT page_id, {_BLOCKS} AS l FROM pages))".replace("(generate_subscripts(l, 1) - 1)::INT", "(i - 1)::INT"))
def html_blocks(spark, sf):
    """Blocks by the table function, a row of SQL each."""
    api.register(spark)
    return spark.sql("SELECT p.page_id, b.pos, b.block_type, b.text FROM {pages} p, LATERAL convert_blocks(encode(p.html, 'UTF-8'), 'p.html', 'chunks') b", pages=_table(spark, sf, "pages"))


@_query("SELECT doc_id, unnest(range((n + 6) // 7))::INT AS chunk_no, unnest(list_transform(range((n + 6) // 7), lambda i: (7 * i) || '-' || least(7 * i + 6, n - 1))) AS page_range FROM (SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n FROM documents)")
def chunk_plan_table(spark, sf):
    api.register(spark)
    return spark.sql("SELECT d.doc_id, c.chunk_no, c.page_range FROM {docs} d, LATERAL plan_chunks(size(split(d.text, '\n')), 7) c", docs=_table(spark, sf, "documents"))


@_query("SELECT page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS heading, len(regexp_extract_all(html, '(?i)<p\\b'))::BIGINT AS n_paragraphs FROM pages")
def html_headings(spark, sf):
    return _table(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1).alias("heading"), F.regexp_count("html", F.lit(r"(?i)<p\b")).cast("long").alias("n_paragraphs"))


@_query("SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\\b[^>]*href=\"([^\"]*)\"', 1) AS l FROM pages)")
def html_links(spark, sf):
    links = F.regexp_extract_all("html", F.lit(r'(?i)<a\b[^>]*href="([^"]*)"'), F.lit(1))
    return _table(spark, sf, "pages").select("page_id", F.posexplode(links).alias("pos", "href")).withColumn("pos", F.col("pos").cast("long"))


@_query("SELECT page_id, regexp_extract(url, '[^/](\\.[^./]+)$', 1) AS suffix FROM pages")
def url_suffix(spark, sf):
    return _table(spark, sf, "pages").select("page_id", text.suffix(F.col("url")).alias("suffix"))


@_query("SELECT page_id, CASE WHEN regexp_extract(url, '[^/](\\.[^./]+)$', 1) = '' THEN url || '.md' ELSE regexp_replace(url, '\\.[^./]+$', '.md') END AS output FROM pages")
def output_paths(spark, sf):
    return _table(spark, sf, "pages").select("page_id", text.output_path(F.col("url")).alias("output"))


def _shown_sql() -> str:
    """Letters and digits of a page's shown text in page order: parts that are not shown go, then tags and character references."""
    text = "html"
    for part in ("<!--.*?-->", *(f"<{t}\\b.*?</{t}\\s*>" for t in ("title", "script", "style", "nav", "footer")), "<[a-z/!][^>]*>", "&[a-z]+;"):
        text = f"regexp_replace({text}, '(?is){part}', '', 'g')"
    return f"regexp_replace({text}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


_SHOWN = _shown_sql()


def _letters(shown):
    return F.regexp_replace(shown, r"[^\p{L}\p{N}]+", "")


# --- base64 and batches ---------------------------------------------------------


@_query("SELECT page_id, to_base64(encode(html)) AS encoded, decode(from_base64(to_base64(encode(html)))) = html AS same FROM pages")
def base64_roundtrip(spark, sf):
    e = text.encode64(F.encode("html", "UTF-8"))
    return _table(spark, sf, "pages").select("page_id", e.alias("encoded"), (F.decode(text.decode64(e), "UTF-8") == F.col("html")).alias("same"))


def _batch(spark, sf):
    bad = F.when(F.col("page_id") % 7 == 3, F.lit("!!!not-valid-base64!!!")).otherwise(text.encode64(F.encode("html", "UTF-8")))
    return _table(spark, sf, "pages").select(F.col("page_id").alias("doc_pos"), F.concat(F.lit("page-"), "page_id", F.lit(".html")).alias("filename"), bad.alias("content_base64"))


@_query(f"SELECT page_id AS doc_pos, 'page-' || page_id || '.html' AS filename, page_id % 7 <> 3 AS success, CASE WHEN page_id % 7 <> 3 THEN {_MARKDOWN} END AS content FROM pages")
def batch_results(spark, sf):
    return convert.convert_batch(_batch(spark, sf))[0].select("doc_pos", "filename", "success", "content")


@_query("SELECT count(*) AS total, count_if(page_id % 7 <> 3)::BIGINT AS successful, count_if(page_id % 7 = 3)::BIGINT AS failed FROM pages")
def batch_summary(spark, sf):
    return convert.convert_batch(_batch(spark, sf))[1]


@_query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'PNG' WHEN 1 THEN 'JPEG' WHEN 2 THEN 'TIFF' WHEN 3 THEN 'WEBP' ELSE 'GIF' END AS format, CASE page_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/tiff' WHEN 3 THEN 'image/webp' ELSE 'image/gif' END AS media_type FROM pages")
def image_formats(spark, sf):
    name = F.concat(F.lit("figure"), F.element_at(F.array(*map(F.lit, (".png", ".JPG", ".tif", ".x", ".gif"))), (F.col("page_id") % 5 + 1).cast("int")))
    own = F.when(F.col("page_id") % 5 == 3, "webp")
    return _table(spark, sf, "pages").select("page_id", text.image_format(name, own).alias("format"), text.media_type(name, own).alias("media_type"))


# --- ranges and chunk plans ------------------------------------------------------


@_query("SELECT doc_id, unnest(range((n + 3) // 4))::INT AS chunk_no, unnest(list_transform(range((n + 3) // 4), lambda i: (4 * i) || '-' || least(4 * i + 3, n - 1))) AS page_range FROM (SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n FROM documents)")
def chunk_plan(spark, sf):
    n = F.size(F.split("text", "\n"))
    return _table(spark, sf, "documents").select("doc_id", F.posexplode(ranges.chunk_total(n, F.lit(4))).alias("chunk_no", "page_range"))


#: Ranges made from the id: a page, a span and a page, out of order for odd ids.
_RANGE = "CASE WHEN doc_id % 2 = 0 THEN (doc_id % 5) || ', ' || (doc_id % 5 + 2) || '-' || (doc_id % 5 + 4) || ',,' || (doc_id % 5 + 5) ELSE (doc_id % 4 + 3) || '-' || (doc_id % 4 + 5) || ',' || (doc_id % 3) END"
_PAGES = "CASE WHEN doc_id % 2 = 0 THEN [doc_id % 5, doc_id % 5 + 2, doc_id % 5 + 3, doc_id % 5 + 4, doc_id % 5 + 5] ELSE [doc_id % 4 + 3, doc_id % 4 + 4, doc_id % 4 + 5, doc_id % 3] END"


def _ranged(spark, sf):
    return _table(spark, sf, "documents").select("*", F.expr(_RANGE).alias("page_range"))


@_query(f"""WITH p AS (SELECT doc_id, unnest(l) AS page, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, {_PAGES} AS l FROM documents)),
  b AS (SELECT *, pos // 2 AS chunk_no, CASE WHEN page = lag(page) OVER w + 1 THEN 0 ELSE 1 END AS brk FROM p WINDOW w AS (PARTITION BY doc_id, pos // 2 ORDER BY pos)),
  s AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS seg FROM b),
  r AS (SELECT doc_id, chunk_no, seg, min(pos) AS pos, CASE WHEN min(page) = max(page) THEN min(page)::VARCHAR ELSE min(page) || '-' || max(page) END AS t FROM s GROUP BY ALL)
  SELECT doc_id, chunk_no::INT AS chunk_no, string_agg(t, ',' ORDER BY pos) AS page_range FROM r GROUP BY ALL""")
def range_rechunk(spark, sf):
    return _ranged(spark, sf).select("doc_id", F.posexplode(ranges.chunk_requested(F.col("page_range"), F.lit(2))).alias("chunk_no", "page_range"))


@_query(f"SELECT doc_id, unnest(l)::INT AS page, (generate_subscripts(l, 1) - 1)::INT AS pos FROM (SELECT doc_id, {_PAGES} AS l FROM documents)")
def range_parse(spark, sf):
    return _ranged(spark, sf).select("doc_id", F.posexplode(ranges.parse_pages(F.col("page_range"))).alias("pos", "page"))


@_query("""WITH b AS (SELECT user_id, event_id, CASE WHEN event_id = lag(event_id) OVER w + 1 THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY event_id) AS seg FROM b)
  SELECT user_id, min(event_id) AS first_page, max(event_id) AS last_page FROM s GROUP BY user_id, seg""")
def run_compaction(spark, sf):
    return ranges.runs(_table(spark, sf, "events"), "user_id", "event_id").withColumnsRenamed({"first": "first_page", "last": "last_page"})


@_query("SELECT doc_id, unnest(CASE WHEN doc_id % 3 = 0 THEN [NULL] WHEN n <= 6 THEN [NULL] ELSE list_transform(range((n + 5) // 6), lambda i: (6 * i) || '-' || least(6 * i + 5, n - 1)) END) AS page_range FROM (SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n FROM documents)")
def conversion_plan(spark, sf):
    n = F.size(F.split("text", "\n"))
    suffix = F.when(F.col("doc_id") % 3 == 0, ".html").otherwise(".PDF")
    return _table(spark, sf, "documents").select("doc_id", F.explode(ranges.plan_chunks(F.lit(None).cast("string"), n, F.lit(6), suffix)).alias("page_range"))


@_query("SELECT doc_id, array_to_string(list_filter(list_transform([2, 0], lambda i: string_split(text, chr(10))[i + 1]), lambda x: x IS NOT NULL AND x <> ''), chr(10) || chr(10)) AS text FROM documents")
def page_prune_merge(spark, sf):
    pages = F.split("text", "\n")
    wanted = F.transform(ranges.parse_pages(F.lit("2,0")), lambda i: F.get(pages, i))
    return _table(spark, sf, "documents").select("doc_id", text.join_texts(wanted).alias("text"))


@_query("SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: chr(10) || chr(10) || '{' || (i - 1) || '}' || repeat('-', 48) || chr(10) || chr(10) || x), '') AS paginated FROM documents")
def paginated_output(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", text.paginate(F.split("text", "\n")).alias("paginated"))


# --- merging --------------------------------------------------------------------


def _chunks(spark, sf):
    """Turns of a conversation as chunks of a document."""
    rows = _table(spark, sf, "conversations")
    meta = F.create_map("role", F.col("turn").cast("string"), F.lit("last"), F.col("role"))
    asset = F.struct(F.concat(F.col("role"), F.lit("-"), F.col("turn").cast("string"), F.lit(".png")).alias("filename"), F.lit(None).cast("string").alias("path"), F.lit("AA==").alias("content_base64"), F.lit("image/png").alias("media_type"))
    return rows.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("chunk_no"), "text", F.when(F.col("turn") % 2 == 0, F.length("text")).cast("long").alias("page_count"), meta.alias("metadata"), F.array(F.concat(F.col("role"), F.lit(":"), F.col("turn").cast("string"))).alias("warnings"), merge.groups_of(F.to_json(F.create_map(F.lit("images"), F.array(asset)))).alias("assets"))


@_query("SELECT conv_id AS doc_id, coalesce(string_agg(nullif(text, ''), chr(10) || chr(10) ORDER BY turn), '') AS text FROM conversations GROUP BY conv_id")
def chunk_text_merge(spark, sf):
    return merge.merge_chunks(_chunks(spark, sf)).select("doc_id", "text")


@_query("SELECT conv_id AS doc_id, coalesce(string_agg(CASE WHEN turn % 2 = 1 THEN nullif(text, '') END, chr(10) || chr(10) ORDER BY turn), '') AS text FROM conversations GROUP BY conv_id")
def merge_coalesce(spark, sf):
    rows = _chunks(spark, sf).withColumn("text", F.when(F.col("chunk_no") % 2 == 1, F.col("text")))
    return merge.merge_chunks(rows).select("doc_id", "text")


@_query("SELECT conv_id AS doc_id, role AS key, max(turn)::VARCHAR AS value FROM conversations GROUP BY ALL UNION ALL SELECT conv_id, 'last', arg_max(role, turn) FROM conversations GROUP BY conv_id")
def metadata_last_wins(spark, sf):
    return merge.merge_chunks(_chunks(spark, sf)).select("doc_id", F.explode("metadata").alias("key", "value"))


@_query("SELECT conv_id AS doc_id, sum(CASE WHEN turn % 2 = 0 THEN length(text) END)::BIGINT AS page_count FROM conversations GROUP BY conv_id")
def page_count_sum(spark, sf):
    return merge.merge_chunks(_chunks(spark, sf)).select("doc_id", "page_count")


@_query("SELECT user_id, sum((props::JSON->>'k')::BIGINT)::BIGINT AS k FROM events GROUP BY user_id")
def metadata_sum(spark, sf):
    return _table(spark, sf, "events").groupBy("user_id").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


@_query("SELECT conv_id AS doc_id, string_agg(role || ':' || turn, '|' ORDER BY turn) AS warnings FROM conversations GROUP BY conv_id")
def warnings_concat(spark, sf):
    return merge.merge_chunks(_chunks(spark, sf)).select("doc_id", F.array_join("warnings", "|").alias("warnings"))


@_query("SELECT conv_id AS doc_id, 'images' AS asset_group, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, role || '-' || turn || '.png' AS filename, 'AA==' AS content_base64, 'image/png' AS media_type FROM conversations")
def asset_extend(spark, sf):
    return assets.asset_rows(merge.merge_chunks(_chunks(spark, sf)))


@_query("""SELECT conv_id AS doc_id, coalesce(string_agg(nullif(text, ''), chr(10) || chr(10) ORDER BY turn), '') AS text, sum(CASE WHEN turn % 2 = 0 THEN length(text) END)::BIGINT AS page_count,
  string_agg(role || ':' || turn, '|' ORDER BY turn) AS warnings, arg_max(role, turn) AS last_role, string_agg(role || '-' || turn || '.png', '|' ORDER BY turn) AS images FROM conversations GROUP BY conv_id""")
def result_json(spark, sf):
    made = convert.result_json(merge.merge_chunks(_chunks(spark, sf)))
    got = F.from_json("result", "text string, page_count long, metadata map<string,string>, warnings array<string>, assets struct<images:array<struct<filename:string>>>")
    r = made.select("doc_id", got.alias("r"))
    return r.select("doc_id", "r.text", "r.page_count", F.array_join("r.warnings", "|").alias("warnings"), F.element_at("r.metadata", F.lit("last")).alias("last_role"), F.array_join("r.assets.images.filename", "|").alias("images"))


@_query(r"""SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'ValueError: page_range end must be greater than or equal to start.' WHEN 2 THEN 'ValueError: page_range must hold page numbers and spans of them.' END AS error,
  CASE WHEN doc_id % 4 IN (0, 3) THEN array_to_string(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')), chr(10)) END AS text FROM documents""")
def range_errors(spark, sf):
    d = F.col("doc_id") % 4
    docs = _table(spark, sf, "documents").select("doc_id", F.lit("d.txt").alias("filename"), F.encode(F.replace("text", F.lit("\n"), F.lit("\n\n")), "UTF-8").alias("content"), F.when(d == 0, "0-999999999").when(d == 1, "5-3").when(d == 2, "1-x").alias("asked"))
    got = convert.convert_documents(docs, options.build_options(page_range=F.col("asked")))
    return got.select("doc_id", "error", F.replace("text", F.lit("\n\n"), F.lit("\n")).alias("text"))


@_query("""WITH p AS (SELECT doc_id, unnest(l) AS page, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT doc_id, list_concat(range(doc_id % 7, len(string_split(text, chr(10)))::BIGINT), [0]) AS l FROM documents)),
  b AS (SELECT *, pos // 5 AS chunk_no, CASE WHEN page = lag(page) OVER w + 1 THEN 0 ELSE 1 END AS brk FROM p WINDOW w AS (PARTITION BY doc_id, pos // 5 ORDER BY pos)),
  s AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS seg FROM b),
  r AS (SELECT doc_id, chunk_no, seg, min(pos) AS pos, CASE WHEN min(page) = max(page) THEN min(page)::VARCHAR ELSE min(page) || '-' || max(page) END AS t FROM s GROUP BY ALL)
  SELECT doc_id, chunk_no::INT AS chunk_no, string_agg(t, ',' ORDER BY pos) AS page_range FROM r GROUP BY ALL""")
def range_clip(spark, sf):
    """A span of a thousand million pages and a page, clipped to each document and cut to chunks of five."""
    rows = _table(spark, sf, "documents").select("doc_id", F.size(F.split("text", "\n")).alias("n"), F.concat(F.col("doc_id") % 7, F.lit("-999999999, 0")).alias("asked"))
    cut = ranges.chunk_spans(ranges.clip_spans(ranges.parse_spans(F.col("asked")), F.col("n")), F.lit(5))
    return rows.select("doc_id", F.posexplode(cut).alias("chunk_no", "page_range"))


# --- predicates and options ---------------------------------------------------------


@_query("""SELECT doc_id, regexp_matches(lower(m), 'cuda out of memory|hip out of memory') AS out_of_memory, regexp_matches(lower(m), 'llm|ollama|openai|anthropic|claude|gemini|google') AS llm
  FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'HIP out of Memory. ' ELSE 'failed ' END || text || CASE WHEN doc_id % 4 = 1 THEN ' Gemini call' ELSE '' END AS m FROM documents)""")
def error_classification(spark, sf):
    """Messages that hold a document's whole text."""
    d = F.col("doc_id")
    message = F.concat(F.when(d % 3 == 0, "HIP out of Memory. ").otherwise("failed "), "text", F.when(d % 4 == 1, " Gemini call").otherwise(""))
    return _table(spark, sf, "documents").select("doc_id", predicates.is_out_of_memory(message, F.lit("RuntimeError")).alias("out_of_memory"), predicates.is_llm_failure(message).alias("llm"))


class Extras:
    """A backend that gives back what it read as a payload beside the text."""

    def convert(self, content, suffix, given, device):
        return {"text": "t", "extras": [json.loads(content)]}


@_query("""SELECT event_id AS doc_id, event_id % 4 IN (0, 1) AS is_assets, CASE WHEN event_id % 4 > 1 THEN props::JSON->>'k' END AS k FROM events""")
def asset_classification(spark, sf):
    e = F.col("event_id") % 4
    payload = F.when(e == 0, F.concat(F.lit('{"images": {}, "p": '), "props", F.lit("}"))).when(e == 1, F.concat(F.lit('{"x": [{"Path": "a"}], "p": '), "props", F.lit("}"))).when(e == 2, F.concat(F.lit('{"x": "a path", "p": '), "props", F.lit("}"))).otherwise(F.concat(F.lit('{"p": '), "props", F.lit("}")))
    docs = _table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.lit("e.json").alias("filename"), F.encode(payload, "UTF-8").alias("content"))
    got = convert.convert_documents(docs, options.build_options(), backend=Extras(), merged=False)
    return got.select("doc_id", (F.cardinality("assets") > 0).alias("is_assets"), F.get_json_object(F.try_element_at("metadata", F.lit("p")), "$.k").alias("k"))


@_query("""WITH c AS (SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN 'list' WHEN turn % 4 = 1 THEN 'object' ELSE 'plain' END AS kind FROM conversations),
  l AS (SELECT conv_id, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS turns FROM conversations GROUP BY conv_id),
  o AS (SELECT conv_id, string_agg(role || ':' || t, ',' ORDER BY role) AS roles FROM (SELECT conv_id, role, max(turn) AS t FROM conversations GROUP BY ALL) GROUP BY conv_id),
  last AS (SELECT conv_id, arg_max(kind, turn) AS kind, max(turn) AS turn, max(CASE WHEN kind <> 'list' THEN turn END) AS other, max(CASE WHEN kind <> 'object' THEN turn END) AS unlike FROM c GROUP BY conv_id)
  SELECT conv_id AS doc_id, l.turns AS lists, o.roles AS objects,
    CASE kind WHEN 'list' THEN (SELECT '[' || string_agg(c.turn::VARCHAR, ',' ORDER BY c.turn) || ']' FROM c WHERE c.conv_id = last.conv_id AND c.turn > coalesce(other, -1))
      WHEN 'object' THEN (SELECT '{' || string_agg('"' || r || '":' || t, ',' ORDER BY r) || '}' FROM (SELECT c.role AS r, max(c.turn) AS t FROM c WHERE c.conv_id = last.conv_id AND c.turn > coalesce(unlike, -1) GROUP BY c.role))
      ELSE turn::VARCHAR END AS mixed
  FROM last JOIN l USING (conv_id) JOIN o USING (conv_id)""")
def asset_fold(spark, sf):
    """Lists are put end to end, objects updated, and values of another kind replace what was there."""
    turn, role = F.col("turn").cast("string"), F.col("role")
    a_list, an_object = F.concat(F.lit("["), turn, F.lit("]")), F.concat(F.lit('{"'), role, F.lit('":'), turn, F.lit("}"))
    mixed = F.when(F.col("turn") % 2 == 0, a_list).when(F.col("turn") % 4 == 1, an_object).otherwise(turn)
    payload = F.concat(F.lit('{"l":'), a_list, F.lit(',"o":'), an_object, F.lit(',"m":'), mixed, F.lit("}"))
    rows = _chunks(spark, sf).drop("assets").join(_table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("chunk_no"), merge.groups_of(payload).alias("assets")), ["doc_id", "chunk_no"])
    got = merge.merge_chunks(rows).select("doc_id", *(F.element_at("assets", F.lit(k)).alias(k) for k in "lom"))
    roles = F.map_entries(F.col("o").cast("map<string,bigint>"))
    pairs = F.array_join(F.array_sort(F.transform(roles, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))), ",")
    return got.select("doc_id", F.array_join(F.col("l").cast("array<string>"), ",").alias("lists"), pairs.alias("objects"), F.to_json("m").alias("mixed"))


@_query("SELECT doc_id, 'markdown' AS output_format, CASE WHEN doc_id % 2 = 0 THEN '0-3' END AS page_range, CASE WHEN doc_id % 3 = 0 THEN '0' END AS max_pages_per_chunk, CASE WHEN doc_id % 5 = 0 THEN true END AS force_ocr, NULL::BOOLEAN AS paginate_output, CASE WHEN doc_id % 7 = 0 THEN true END AS use_llm, CASE WHEN doc_id % 7 = 0 THEN 'ollama' END AS llm_service FROM documents")
def option_build(spark, sf):
    d = F.col("doc_id")
    llm = F.create_map(F.lit("llm_service"), F.lit("ollama"), F.lit("ollama_model"), F.lit("m"))
    made = options.build_options("markdown", F.when(d % 2 == 0, "0-3").otherwise(""), d % 5 == 0, False, d % 7 == 0, F.when(d % 3 == 0, 0), llm)
    return _table(spark, sf, "documents").select("doc_id", made.alias("o")).select("doc_id", "o.*").drop("extra").withColumn("max_pages_per_chunk", F.col("max_pages_per_chunk").cast("string"))


@_query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'kept' END AS other FROM documents")
def option_strip(spark, sf):
    d = F.col("doc_id")
    llm = F.create_map(F.lit("llm_service"), F.lit("openai"), F.lit("openai_model"), F.lit("m"), F.lit("other"), F.lit("kept"))
    made = options.without_llm(options.without_chunking(options.build_options(use_llm=d % 7 == 0, llm=llm, max_pages_per_chunk=3)))
    rows = _table(spark, sf, "documents").select("doc_id", made.alias("o"))
    clean = F.col("o.use_llm").isNull() & F.col("o.llm_service").isNull() & F.col("o.max_pages_per_chunk").isNull() & (F.coalesce(F.size(F.map_filter("o.extra", lambda k, v: k != "other")), F.lit(0)) <= 0)
    return rows.select("doc_id", F.when(clean, F.try_element_at("o.extra", F.lit("other"))).otherwise(F.lit("not clean")).alias("other"))


@_query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'own.Service' WHEN event_id % 3 = 0 THEN 'ollama' WHEN event_id % 5 = 0 THEN 'openai' WHEN event_id % 7 = 0 THEN 'claude' END AS service, CASE WHEN event_id % 7 = 0 THEN 'key' END AS claude_key FROM events")
def llm_priority(spark, sf):
    e = F.col("event_id")
    on = lambda n, v: F.when(e % n == 0, v).otherwise("")
    env = F.create_map(F.lit(settings.SERVICE_KEY), on(2, "own.Service"), F.lit("OLLAMA_MODEL"), on(3, "m"), F.lit("OPENAI_API_KEY"), on(5, "key"), F.lit("OPENAI_MODEL"), F.lit("m"), F.lit("CLAUDE_API_KEY"), on(7, "key"))
    made = settings.llm_options(env)
    return _table(spark, sf, "events").select("event_id", F.try_element_at(made, F.lit("llm_service")).alias("service"), F.try_element_at(made, F.lit("claude_api_key")).alias("claude_key"))


@_query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'cpu' WHEN 1 THEN 'cuda' WHEN 2 THEN 'cuda' WHEN 3 THEN '__auto__' END AS device, CASE doc_id % 2 WHEN 0 THEN 'float16' END AS dtype FROM documents")
def device_alias(spark, sf):
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (F.col("doc_id") % len(v) + 1).cast("int"))
    return _table(spark, sf, "documents").select("doc_id", settings.device(pick(" CPU", "amd", "Nvidia", "auto ", " ")).alias("device"), settings.precision(pick("Float16", "")).alias("dtype"))


@_query(r"""SELECT page_id, CASE page_id % 4 WHEN 2 THEN false WHEN 3 THEN false ELSE len(list_filter(string_split(p, '/'), lambda x: x NOT IN ('', '.', '..'))) > CASE WHEN page_id % 4 = 1 THEN 1 ELSE 0 END END AS safe
  FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages)""")
def safe_asset_names(spark, sf):
    """Paths made of the pages' addresses: as they are, with a step up at the end, at the beginning, and from the root."""
    path = F.regexp_replace("url", "^[a-z]+://", "")
    names = F.array(path, F.concat(path, F.lit("/..")), F.concat(F.lit("../"), path), F.concat(F.lit("/"), path))
    return _table(spark, sf, "pages").select("page_id", assets.is_safe_name(F.get(names, (F.col("page_id") % 4).cast("int"))).alias("safe"))


@_query("SELECT n = 0 AS initialized, CASE WHEN n = 0 THEN 'ready' ELSE 'failed' END AS status, 'The converter ' || CASE WHEN n = 0 THEN 'is ready.' ELSE 'could not be initialised.' END AS message FROM (SELECT count_if(html IS NULL) AS n FROM pages)")
def converter_status(spark, sf):
    """Every page tried by the workers."""
    return api.status(spark, probe=_html_docs(spark, sf))


# --- whole conversions, by their text -------------------------------------------------------


def _html_docs(spark, sf):
    return _table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.lit("p.html").alias("filename"), F.encode("html", "UTF-8").alias("content"))


@_query(f"SELECT page_id AS doc_id, {_SHOWN} AS letters, regexp_matches(html, '(?i)<h1\\b') AS has_heading, 1::BIGINT AS page_count, NULL::VARCHAR AS error FROM pages")
def convert_json_blocks(spark, sf):
    got = convert.convert_documents(_html_docs(spark, sf), options.build_options("json"), merged=False)
    blocks = F.flatten(F.transform(F.from_json("text", "children array<struct<children array<struct<block_type string, text string>>>>")["children"], lambda p: p["children"]))
    shown = F.array_join(F.transform(F.filter(blocks, lambda b: b["block_type"] != "image"), lambda b: b["text"]), "")
    return got.select("doc_id", _letters(shown).alias("letters"), F.exists(blocks, lambda b: b["block_type"] == "heading").alias("has_heading"), "page_count", "error")


@_query(f"SELECT page_id AS doc_id, {_MARKDOWN} AS text, 1::BIGINT AS page_count, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) <> '' AS has_title, NULL::VARCHAR AS error FROM pages")
def convert_markdown_result(spark, sf):
    got = convert.convert_documents(_html_docs(spark, sf), options.build_options(max_pages_per_chunk=2))
    return got.select("doc_id", "text", "page_count", F.coalesce(F.map_contains_key("metadata", F.lit("title")), F.lit(False)).alias("has_title"), "error")


_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
for _name, _sign in (("copy", "©"), ("middot", "·"), ("nbsp", " "), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    _TITLE = f"replace({_TITLE}, '&{_name};', '{_sign}')"


@_query(f"SELECT page_id AS doc_id, {_MARKDOWN} AS text, 1::BIGINT AS page_count, nullif(trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')), '') AS title, '{convert.NO_OCR}|{ranges.PAST_END}' AS warnings, NULL::VARCHAR AS error FROM pages")
def result_fields(spark, sf):
    """Text, metadata and warnings of a structured result."""
    got = api.convert_result(_html_docs(spark, sf), page_range="0-4", force_ocr=True)
    return got.select("doc_id", "text", "page_count", F.try_element_at("metadata", F.lit("title")).alias("title"), F.array_join("warnings", "|").alias("warnings"), "error")


@_query(f"SELECT 'site/' || page_id % 5 || '/page-' || page_id || '.md' AS name, {_MARKDOWN} AS text FROM pages")
def written_files(spark, sf):
    """Texts that the sink has written to files below folders, read again."""
    place = passes.shared_folder(spark)
    folder = sink.local_path(f"{place.rstrip('/')}/files-{uuid.uuid4().hex}") if place else tempfile.mkdtemp(prefix="docengine-files-")
    name = F.concat(F.lit("site/"), F.col("doc_id") % 5, F.lit("/page-"), "doc_id", F.lit(".html"))
    sink.write_files(api.convert_result(_html_docs(spark, sf).withColumn("filename", name)), folder)
    files = spark.read.text(f"file://{folder}/site", wholetext=True, recursiveFileLookup=True).withColumn("path", F.input_file_name())
    return files.select(F.regexp_extract("path", "(site/.*)$", 1).alias("name"), F.col("value").alias("text"))


def pdf_of(pages: list[str], packed: bool = False) -> bytes:
    """A small PDF with one line of text a page."""
    kids = " ".join(f"{3 + 2 * i} 0 R" for i in range(len(pages)))
    out = [b"%PDF-1.4\n1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n", f"2 0 obj\n<< /Type /Pages /Count {len(pages)} /Kids [{kids}] >>\nendobj\n".encode()]
    for i, t in enumerate(pages):
        t = t.replace("\\", r"\\").replace("(", r"\(").replace(")", r"\)")
        data = b"BT /F1 12 Tf 72 700 Td (" + t.encode("latin-1", "replace") + b") Tj ET"
        more = b" /Filter /FlateDecode" if packed else b""
        data = zlib.compress(data) if packed else data
        out.append(f"{3 + 2 * i} 0 obj\n<< /Type /Page /Parent 2 0 R /Contents {4 + 2 * i} 0 R >>\nendobj\n{4 + 2 * i} 0 obj\n<< /Length {len(data)}".encode() + more + b" >>\nstream\n" + data + b"\nendstream\nendobj\n")
    return b"".join(out) + b"trailer << /Root 1 0 R >>\n%%EOF\n"


def docx_of(paragraphs: list[str]) -> bytes:
    import html

    body = "".join(f"<w:p><w:r><w:t>{html.escape(p)}</w:t></w:r></w:p>" for p in paragraphs)
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="urn:w"><w:body>{body}</w:body></w:document>')
    return box.getvalue()


def _made(spark, sf, kind: str) -> DataFrame:
    """The lines of every document as pages of a PDF or paragraphs of a DOCX."""
    import pyarrow as pa

    def make(texts: pa.Array) -> pa.Array:
        lines = [(t or "").split("\n") for t in texts.to_pylist()]
        return pa.array([pdf_of(x, len(x) % 2 == 0) if kind == "pdf" else docx_of(x) for x in lines], pa.binary())

    make.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return _table(spark, sf, "documents").select("doc_id", F.lit(f"d.{kind}").alias("filename"), F.arrow_udf(make, "binary")("text").alias("content"))


#: Trimmed lines that are not empty, a blank line between them.
_LINES = r"array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10))"


@_query(f"SELECT doc_id, {_LINES} AS text, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS page_count, NULL::VARCHAR AS error FROM documents")
def pdf_convert(spark, sf):
    got = convert.convert_documents(_made(spark, sf, "pdf"), options.build_options(max_pages_per_chunk=16))
    return got.select("doc_id", "text", "page_count", "error")


@_query(f"SELECT doc_id, {_LINES} AS text, 1::BIGINT AS page_count, NULL::VARCHAR AS error FROM documents")
def ooxml_convert(spark, sf):
    return convert.convert_documents(_made(spark, sf, "docx"), options.build_options(), merged=False).select("doc_id", "text", "page_count", "error")


class Flaky:
    """A backend that runs out of memory off the CPU and cannot reach its model, for the ladder."""

    def convert(self, content, suffix, given, device):
        n = len(content)
        if n % 2 == 0 and device != "cpu":
            raise RuntimeError("CUDA out of memory. Tried to allocate")
        if n % 3 == 0 and given.get("use_llm"):
            raise ConnectionError("LLM service unavailable")
        if n % 5 == 0:
            raise ValueError("broken document")
        return {"text": str(n), "page_count": 1}


@_query(f"""SELECT page_id AS doc_id, CASE WHEN n % 5 <> 0 THEN n::VARCHAR END AS text,
  CASE WHEN n % 5 = 0 THEN 'ValueError: broken document' END AS error,
  array_to_string(list_filter([CASE WHEN n % 2 = 0 THEN '{convert.MEMORY_WARNING}' END, CASE WHEN n % 3 = 0 THEN '{convert.LLM_WARNING}' END], lambda x: x IS NOT NULL), '|') AS warnings
  FROM (SELECT page_id, strlen(html)::BIGINT AS n FROM pages)""")
def fallback_ladder(spark, sf):
    docs = _table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.lit("p.html").alias("filename"), F.encode("html", "UTF-8").alias("content"))
    got = convert.convert_documents(docs, options.build_options(use_llm=True), backend=Flaky(), merged=False)
    return got.select("doc_id", "text", "error", F.array_join("warnings", "|").alias("warnings"))


@_query(_SQL["fallback_ladder"])
def ladder_in_passes(spark, sf):
    """The same rows as the ladder's, where documents out of memory go on in a second pass."""
    got = convert.convert_in_passes(_html_docs(spark, sf), options.build_options(use_llm=True), backend=Flaky())
    return got.select("doc_id", "text", "error", F.array_join("warnings", "|").alias("warnings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
