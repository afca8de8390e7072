"""HTML main text by consensus paths of hosts.

Good text is text outside menus, adverts, forms and the like, not mainly links.
First Spark counts, by host, the own texts of each container path (of tags and
classes, with digits generalised): a path whose text is the same on most of the
pages that have it is the host's, not the article's, unless it is on the way to
the path with most letters or inside the same article. Then each page votes for
the path of its smallest container that holds all good text that is left, and
the path with most votes is looked up on every page of the host. Where good text
lies outside it, the ancestor that holds all is taken; a page without the path
takes its own smallest container. No part of the good text that is not the
host's is given up. The text of the container is then taken, again without the
parts that are not text of the article.

Defined cases: null, empty or blank html gives the empty text; a page without
markup is one block; unclosed and misnested tags are closed where HTML closes
them; a null url is a host of its own, the empty one; repeated rows vote each
and get equal texts; an empty table gives no rows; other columns pass through
and columns of the outputs' names are replaced. Whole pages are read.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize

# Element names of the language, and words that name parts of a page.
RAW = ["script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "select", "canvas", "audio", "video"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
BLOCK = ["address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"]
CELL = ["td", "th"]
CONTAINER = ["article", "body", "div", "main", "section", "td"]
DROPPED = ["aside", "button", "dialog", "footer", "form", "head", "header", "label", "menu", "nav"]
ROLES = ["alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"]
PARTS = ["ad", "ads", "adbox", "advert", "advertisement", "adverts", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "dialog", "discussion", "disqus", "footer", "form", "gdpr", "header", "legal", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pagination", "pager", "popup", "privacy", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget"]
GENERIC = ["area", "articles", "bar", "block", "body", "bottom", "box", "button", "center", "column", "container", "content", "field", "fixed", "footer", "form", "global", "group", "holder", "home", "inner", "input", "item", "items", "layout", "leaderboard", "left", "link", "links", "list", "listing", "main", "middle", "module", "outer", "page", "panel", "posts", "primary", "rail", "rectangle", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "stories", "tertiary", "top", "unit", "wrap", "wrapper"]
CLOSES = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"], "th": ["td", "th"], "option": ["option"], "tbody": ["tr", "td", "th", "thead", "tbody"], "tfoot": ["tr", "td", "th", "thead", "tbody"]}
LIST_EDGE = {"li": ["ul", "ol", "menu"], "dt": ["dl"], "dd": ["dl"], "tr": ["table"], "td": ["table"], "th": ["table"], "tbody": ["table"], "tfoot": ["table"]}

#: Words for parts that never hold the article, however long they are.
NEVER = ["comment", "comments", "discussion", "disqus", "footer", "nav", "navbar", "navigation", "related", "replies", "reply", "respond", "sidebar"]

_NEVER = frozenset(NEVER)
_RAW, _VOID, _BLOCK, _CELL, _CONTAINER, _DROPPED, _ROLES, _PARTS, _GENERIC = map(frozenset, (RAW, VOID, BLOCK, CELL, CONTAINER, DROPPED, ROLES, PARTS, GENERIC))
#: Elements that a class or id may make a part of the page: not the article, its title or its paragraphs.
_NAMED = (_BLOCK | _CELL | {"span"}) - {"article", "main", "body", "html", "p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile("[\"'>]")
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_WORD = re.compile(r"[a-z]{2,}")
_DIGITS = re.compile(r"\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Pages with one text at a path, at least, for it to be the host's.
LEAST_PAGES = 3
MAX_DEPTH = 400  # deeper elements count as part of their ancestor


class Element:
    __slots__ = ("parent", "tag", "step", "own", "wraps", "dropped", "depth", "good", "order")

    def __init__(self, parent, tag, step, own, order, wraps=False):
        self.parent, self.tag, self.step, self.order = parent, tag, step, order
        self.own, self.wraps = own, wraps  # dropped for its own sake; and for a reason that a wrapper of the article may have too
        self.dropped = own or (parent is not None and parent.dropped)
        self.depth = 0 if parent is None else parent.depth + 1
        self.good = 0

    def path(self) -> str:
        steps, e = [], self
        while e is not None:
            if e.step:
                steps.append(e.step)
            e = e.parent
        return ">".join(reversed(steps))


def _names_part(value: str) -> bool:
    """Whether a class or id names a part of the page that is not the article.

    A name must consist of words for parts, and of words for places and boxes beside
    them: ``site-header`` is one, ``no-sidebar``, ``social-history`` and ``has-comments`` are none.
    """
    for name in value.split():
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        if any(w in _PARTS for w in words) and all(w in _PARTS or w in _GENERIC for w in words):
            return True
    return False


def _tags(text: str):
    """(text before, whether it is an end tag, name, attributes) of the marks of a page, in one pass.

    The name is None for comments and at the end, and empty for an element whose content is no text.
    A tag ends at the first > outside quotes. Once a tag has none, quotes count
    no more on this page, so that broken markup costs no second search.
    """
    at, search, n = 0, 0, len(text)
    last, quotes = text.rfind(">"), True
    while True:
        k = text.find("<", search)
        if k < 0 or (k > last and not text.startswith("<!--", k)):
            yield text[at:], False, None, ""
            return
        if text.startswith("<!--", k):
            end = text.find("-->", k + 4)
            end = n if end < 0 else end + 3
            yield text[at:k], False, None, ""
        elif text.startswith(("<!", "<?"), k):
            end = text.find(">", k) + 1
            yield text[at:k], False, None, ""
        elif not (m := _NAME.match(text, k)):
            search = k + 1
            continue
        else:
            end = m.end()
            while quotes:
                mark = _MARK.search(text, end)
                if mark is None:
                    quotes = False
                elif mark[0] == ">":
                    end = mark.end()
                    break
                else:
                    end = text.find(mark[0], mark.end()) + 1
                    quotes = end > 0
            if not quotes:
                end = text.find(">", m.end()) + 1
            ends, tag, attributes = text[k + 1] == "/", m[1].lower(), text[m.end() : end - 1]
            if tag in _RAW and not ends and not attributes.endswith("/"):
                close = _CLOSE[tag].search(text, end)
                end, tag = close.end() if close else n, ""
            yield text[at:k], ends, tag, attributes
        at = search = end


def _element(parent: Element, tag: str, attributes: str, order: int) -> Element:
    classes, dropped, firm = "", False, False
    kept_header = False
    if tag in _DROPPED:
        e = parent
        while tag == "header" and e is not None and not kept_header:  # a header of the article holds its title
            kept_header = e.tag in ("article", "main")
            e = e.parent
        dropped = not kept_header
        firm = dropped and tag != "form"
    if attributes and tag not in ("html", "body"):
        for m in _ATTR.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "class":
                classes = value
            if name in ("class", "id") and tag in _NAMED and not kept_header:
                if _names_part(value):
                    dropped = True
                    firm = firm or not _NEVER.isdisjoint(_WORD.findall(value.lower()))
            elif name == "hidden" or (name == "role" and value.strip().lower() in _ROLES) or (name == "aria-hidden" and value.strip().lower() == "true" and tag in _BLOCK):
                dropped = firm = True
    step = ""
    if tag in _CONTAINER:
        words = sorted({_DIGITS.sub("#", w.lower()) for w in classes.split()})
        step = ".".join([tag, *words])
    return Element(parent, tag, step, dropped, order, dropped and not firm)


def _keep_wrappers(elements: list[Element], blocks: list) -> None:
    """Forms and named boxes that hold the article are no parts of the page beside it.

    Such an element is kept if more than half of the page's text outside links is in it, and an article, a main part or
    a title (a form needs none). What is dropped inside of it stays dropped. Two passes, whatever the depth.
    """
    letters, holds = [0] * len(elements), [e.tag in ("article", "main", "h1") for e in elements]
    for e, t, linked in blocks:
        if 2 * linked < len(t):
            letters[e.order] += len(t)
    for e in reversed(elements[1:]):
        letters[e.parent.order] += letters[e.order]
        holds[e.parent.order] |= holds[e.order]
    for e in elements[1:]:
        if e.own and e.wraps and not e.parent.dropped and 2 * letters[e.order] > letters[0] and (e.tag == "form" or holds[e.order]):
            e.own = False
        e.dropped = e.own or e.parent.dropped


def parse(text: str):
    """(elements, blocks) of a page; a block is (element, text, letters inside links)."""
    root = Element(None, "", "", False, 0)
    elements, blocks = [root], []
    stack, tags = [root], [""]  # beyond MAX_DEPTH an entry repeats its ancestor, or is a dropped part
    open_: Counter[str] = Counter()
    parts: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if parts:
            t = " ".join("".join(parts).split())
            if t:
                blocks.append((stack[-1], t, linked))
            parts.clear()
        linked = 0

    def close(k):
        nonlocal links
        links -= tags[k:].count("a")
        open_.subtract(tags[k:])
        del stack[k:], tags[k:]

    for before, ends, tag, attributes in _tags(text):
        if before:
            piece = _html.unescape(before) if "&" in before else before
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        if not tag:
            if tag == "":
                parts.append(" ")
        elif not ends:
            if tag == "br" or tag in _CELL:
                parts.append(" ")
            if tag in _VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in _BLOCK or tag in _CELL:
                if tag in _BLOCK:
                    flush()
                    for k in range(len(stack) - 1, 0, -1) if open_["p"] > 0 else ():  # a paragraph ends where a block begins
                        if tags[k] == "p":
                            close(k)
                            break
                        if tags[k] in _BLOCK or tags[k] in _CELL:
                            break
                if tag in CLOSES:
                    edge = LIST_EDGE[tag]
                    for k in range(len(stack) - 1, 0, -1) if any(open_[t] > 0 for t in CLOSES[tag]) else ():
                        if tags[k] in edge:
                            break
                        if tags[k] in CLOSES[tag]:
                            close(k)
            if tag == "a":
                links += 1
            e = stack[-1]
            if len(stack) < MAX_DEPTH or not e.dropped:
                inner = _element(e, tag, attributes, len(elements))
                if len(stack) < MAX_DEPTH or inner.dropped:
                    elements.append(inner)
                    e = inner
            stack.append(e)
            tags.append(tag)
            open_[tag] += 1
        else:
            if tag in _BLOCK:
                flush()
            elif tag in _CELL:
                parts.append(" ")
            block = tag in _BLOCK or tag in _CELL
            for k in range(len(stack) - 1, 0, -1) if open_[tag] > 0 else ():
                if tags[k] == tag:
                    close(k)
                    break
                if not block and (tags[k] in _BLOCK or tags[k] in _CELL):
                    break
    flush()
    _keep_wrappers(elements, blocks)
    return elements, blocks


def _container(e: Element) -> Element:
    while not e.step and e.parent is not None:
        e = e.parent
    return e


def _good(block) -> bool:
    e, t, linked = block
    return not e.dropped and 2 * linked < len(t)


def _score(elements, blocks, common) -> int:
    """Good letters of every element's subtree, without those of ``common`` paths; the page's good letters."""
    for block in blocks:
        e = block[0]
        if _good(block) and not (common and _container(e).path() in common):
            while e is not None:
                e.good += len(block[1])
                e = e.parent
    return elements[0].good


def _smallest(elements, total: int) -> Element:
    """The deepest container that holds all good text, or the whole page."""
    return max((e for e in elements if e.step and not e.dropped and total and e.good == total), key=lambda e: e.depth, default=elements[0])


def own_texts(text: str | None) -> dict[str, str]:
    """The good text that is directly in the containers of each path."""
    if not text or not text.strip():
        return {}
    got: dict[str, list[str]] = defaultdict(list)
    for block in parse(text)[1]:
        if _good(block):
            got[_container(block[0]).path()].append(block[1])
    return {p: "\n".join(t) for p, t in got.items() if p}


def votes(text: str | None, common=()) -> dict[str, int]:
    """A vote for the path of the smallest container that holds all good text."""
    if not text or not text.strip():
        return {}
    elements, blocks = parse(text)
    path = _smallest(elements, _score(elements, blocks, common)).path()
    return {path: 1} if path else {}


def extract(text: str | None, path: str | None, common=()) -> tuple[str, str]:
    """(text of the article, path it was taken from)."""
    if not text or not text.strip():
        return "", ""
    elements, blocks = parse(text)
    total = _score(elements, blocks, common)
    chosen = None
    if path:
        last = path.rsplit(">", 1)[-1]
        same = [e for e in elements if e.step == last and not e.dropped and e.good and e.path() == path]
        chosen = max(same, key=lambda e: (e.good, -e.order), default=None)
        while chosen is not None and chosen.parent is not None and (chosen.good < total or not chosen.step):
            chosen = chosen.parent
    if chosen is None:
        chosen = _smallest(elements, total)
    out = []
    for e, t, _ in blocks:
        if e.dropped:
            continue
        while e is not None and e is not chosen:
            e = e.parent
        if e is not None:
            out.append(t)
    return "\n\n".join(out), chosen.path()


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_TEXTS = "host string, path string, text long, pages long, letters long, least long, most long"


def _text_rows(batches):
    for batch in batches:
        total: dict[tuple[str, str, int], list[int]] = {}
        for host, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for p, t in own_texts(page).items():
                key = host, p, int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                r = total.setdefault(key, [0, 0, url, url])
                r[:] = r[0] + 1, r[1] + len(t), min(r[2], url), max(r[3], url)
        columns = list(zip(*((*k, *r) for k, r in total.items()), strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), *[pa.int64()] * 5), strict=True)], ["host", "path", "text", "pages", "letters", "least", "most"])


def common_paths(spark: SparkSession, pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, common): paths whose own text is the same on most pages that have them, under two addresses or more."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.xxhash64(F.col(url_col).cast("string")).alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(_text_rows, _TEXTS)
    texts = rows.groupBy("host", "path", "text").agg(F.sum("pages").alias("pages"), F.sum("letters").alias("letters"), F.min("least").alias("least"), F.max("most").alias("most"))
    paths = texts.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("letters").alias("letters"), F.max(F.when(F.col("least") != F.col("most"), F.col("pages"))).alias("same"))
    paths = materialize(spark, paths, "host-texts")
    most = paths.groupBy("host").agg(F.max(F.struct("letters", "path")).alias("m")).select("host", F.col("m.path").alias("main"))
    article = F.regexp_extract("main", r"^(?:.*?>)?(?:article|main)(?:\.[^>]*)?(?=>|$)", 0)
    own = F.startswith(F.concat("main", F.lit(">")), F.concat("path", F.lit(">"))) | ((article != "") & F.startswith(F.col("path"), F.concat(article, F.lit(">"))))
    repeated = paths.where((F.col("same") >= LEAST_PAGES) & (2 * F.col("same") > F.col("pages"))).join(most, "host").where(~own)
    return materialize(spark, repeated.groupBy("host").agg(F.array_sort(F.collect_list("path")).alias("common")), "host-common")


def _vote_rows(batches):
    for batch in batches:
        total: dict[tuple[str, str], int] = defaultdict(int)
        for host, page, common in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for p, v in votes(page, common or ()).items():
                total[host, p] += v
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in total], pa.string()), pa.array([p for _, p in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["host", "path", "votes"])


def host_paths(spark: SparkSession, pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes, common): the winning path of every host, and its common paths. Ties go to the longer, then later path."""
    common = common_paths(spark, pages, url_col=url_col, html_col=html_col)
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).join(common, "host", "left").mapInArrow(_vote_rows, "host string, path string, votes long")
    counted = rows.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    won = counted.groupBy("host").agg(F.max(F.struct("votes", F.length("path").alias("n"), "path")).alias("w"))
    return materialize(spark, won.select("host", "w.path", "w.votes").join(common, "host", "left"), "host-paths")


def _extract_udf():
    def run(pages: pa.Array, paths: pa.Array, common: pa.Array) -> pa.Array:
        got = [extract(h, p, c or ()) for h, p, c in zip(pages.to_pylist(), paths.to_pylist(), common.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array([t for t, _ in got], pa.string()), pa.array([p for _, p in got], pa.string())], ["text", "path"])

    run.__annotations__ = {"pages": pa.Array, "paths": pa.Array, "common": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<text:string,path:string>")


def extract_pages(spark: SparkSession, pages: DataFrame, *, url_col: str = "url", html_col: str = "html", out: str = "article") -> DataFrame:
    """``pages`` with a struct column ``out`` of text and path.

    The winners have one row per host; Spark broadcasts them where their size
    is small and joins by host, splitting large hosts, where it is not.
    """
    won = host_paths(spark, pages, url_col=url_col, html_col=html_col).select("host", "path", "common")
    row = pages.select(F.struct(*(pages[c] for c in pages.columns if c.lower() != out.lower())).alias("row"), host_of(pages[url_col]).alias("host"), pages[html_col].cast("string").alias("html"))
    joined = row.join(won, "host", "left")
    return joined.select("row", _extract_udf()("html", "path", "common").alias(out)).select("row.*", out)


def page_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    got = extract_pages(spark, pages.select("page_id", "url", "html"))
    return got.select("page_id", "url", F.col("article.text").alias("text"), F.char_length("article.text").cast("long").alias("n_chars"))
