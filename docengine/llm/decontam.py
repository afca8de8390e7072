"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark questions and answers are cut into windows of consecutive words. Every
benchmark word is one sign of an alphabet of its own, so a window is a string of
thirteen signs; the automaton holds the beginnings of all windows, and each text,
written in the same signs, is scanned once. Where a beginning is found, the
window there is looked up among all windows and compared sign by sign. Matches
are kept as word positions and mapped back to character offsets of the original text.

Defined cases: a null or empty text has no words and is clean; an item without
words matches nothing; an item with a null id marks words but is not listed;
repeated items and repeated documents give the same answer for each row; an
empty benchmark or document table is no error, and the first leaves every document clean;
texts and items of any length are scanned whole. Other columns pass through; if
the input has a column of the output's name, it is replaced.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SHARE = 20  # contaminated: SHARE * hit words >= words
#: Text of items that one automaton may hold (some 80 bytes of a worker's memory for each); a larger benchmark is scanned in parts.
PART_BYTES = 24 << 20
#: Words of a window that the automaton knows; automata and found windows that a worker keeps.
BEGINNING, KEPT, MEMO = 3, 2, 100_000
_NO_WORD = "\0"
#: Words that have a code point each.
CODES = 1_000_000

_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPANS)])
_TYPE = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>"
_built: dict[str, Windows] = {}


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_NORMAL).split()


def _sign(k: int) -> str:
    return chr(k if k < 0xD800 else k + 0x800)  # code points without surrogates


class Windows:
    """All windows of the items, as strings of one sign a word.

    ``text`` has the items' words; windows are places in it, sorted by the hash of
    their signs, so that a window costs some bytes and no object.
    """

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        import ahocorasick

        self.names = [item for item, _ in items]
        number: dict[bytes, int] = {}
        for _, text in items:
            for w in normal_words(text):
                number.setdefault(w, len(number) + 1)
        # a word is one code point, or two where there are more words than code points
        self.wide = wide = 1 if len(number) <= CODES else 2
        self.signs: dict[bytes, str] = {w: _sign(k) if wide == 1 else _sign(1 + k // CODES) + _sign(1 + k % CODES) for w, k in number.items()}
        self.no_word = _NO_WORD * wide
        parts, at, size, who, total = [], [], [], [], 0
        for k, (_, text) in enumerate(items):
            line = "".join([self.signs[w] for w in normal_words(text)])
            n = min(window * wide, len(line))
            if n:
                here = (len(line) - n) // wide + 1
                at.append(np.arange(total, total + here * wide, wide))
                size.append(np.full(here, n))
                who.append(np.full(here, k))
                parts.append(line)
                total += len(line)
        self.text = "".join(parts)
        at, size, who = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (at, size, who))
        key = np.fromiter((hash(self.text[a : a + n]) for a, n in zip(at.tolist(), size.tolist(), strict=True)), np.int64, len(at))
        order = np.argsort(key, kind="stable")
        self.key, self.at, self.size, self.who = key[order], at[order], size[order].astype(np.int16 if window * wide < 1 << 15 else np.int64), who[order].astype(np.int32)
        begins: dict[str, set[int]] = {}
        for a, n in zip(at.tolist(), size.tolist(), strict=True):
            begins.setdefault(self.text[a : a + min(n, BEGINNING * wide)], set()).add(n)
        self.automaton = ahocorasick.Automaton()
        shared: dict[tuple, tuple] = {}
        for b, sizes in begins.items():
            value = (len(b), tuple(sorted(sizes)))
            self.automaton.add_word(b, shared.setdefault(value, value))
        self.automaton.make_automaton()
        self.memo: dict[str, tuple[str, ...] | None] = {}

    def items(self, window: str) -> tuple[str, ...] | None:
        """The items that hold a window, or None if none does."""
        if window not in self.memo:
            if len(self.memo) > MEMO:
                self.memo.clear()
            h = hash(window)
            found = range(int(np.searchsorted(self.key, h)), int(np.searchsorted(self.key, h, side="right")))
            same = [int(self.who[k]) for k in found if self.size[k] == len(window) and self.text.startswith(window, int(self.at[k]))]
            self.memo[window] = tuple({self.names[k] for k in same if self.names[k] is not None}) if same else None
        return self.memo[window]

    def scan(self, text: str | None) -> tuple[int, np.ndarray | None, set[str]]:
        """(words, mask of hit words or None, items) of one text."""
        w = normal_words(text)
        if not w or not len(self.automaton):
            return len(w), None, set()
        sign = self.signs.get
        wide = self.wide
        line = "".join([sign(x, self.no_word) for x in w])
        edge, items = None, set()
        for end, (n, sizes) in self.automaton.iter(line):
            start = end - n + 1
            if start % wide:
                continue  # it begins inside a word
            for size in sizes:
                window = line[start : start + size]
                if len(window) < size or _NO_WORD in window:
                    continue
                who = self.items(window)
                if who is not None:
                    if edge is None:
                        edge = np.zeros(len(w) + 1, np.int64)
                    edge[start // wide] += 1
                    edge[(start + size) // wide] -= 1
                    items.update(who)
        return len(w), None if edge is None else np.cumsum(edge)[:-1] > 0, items


def _windows(name: str, items, window: int) -> Windows:
    """The windows of a part of the benchmark, built once in a worker."""
    if name not in _built:
        while len(_built) >= KEPT:
            del _built[next(iter(_built))]
        _built[name] = Windows(items, window)
    return _built[name]


def _original_spans(text: str, hit: np.ndarray) -> list[dict]:
    out: list[dict] = []
    previous = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if hit[i]:
            if previous == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            previous = i
    return out


def _scanner(spark, items, window):
    held, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def scan(texts: pa.Array) -> pa.Array:
        a, rows = _windows(name, held.value, window), []
        for x in texts:
            t = x.as_py() or ""
            n, hit, who = a.scan(t)
            rows.append({"n_words": n, "n_hit": 0 if hit is None else int(hit.sum()), "items": sorted(who), "spans": [] if hit is None else _original_spans(t, hit)})
        return pa.array(rows, _ARROW)

    scan.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(scan, _TYPE)


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int):
    """The items in parts of at most ``part_bytes`` of text (one item at least)."""
    part, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).distinct()
    for item, text in rows.toLocalIterator():
        n = len(text.encode("utf-8", "replace"))
        if part and size + n > part_bytes:
            yield sorted(part, key=repr)
            part, size = [], 0
        part.append((item, text))
        size += n
    yield sorted(part, key=repr)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, share: int = SHARE, part_bytes: int = PART_BYTES, out: str = "decontam") -> DataFrame:
    """``docs`` with a struct column ``out``.

    Fields: n_words, n_hit, items (ids as sorted strings), spans (merged
    character ranges in the original text), contaminated. Rows stay where they
    are: there is no shuffle. The automaton is built once in a worker from the
    items' text, which is broadcast in parts of at most ``part_bytes``; with several
    parts, each scans the text and the spans are merged.
    """
    docs = docs.drop(out)
    for k, items in enumerate(_parts(benchmark, item_col, item_text_col, part_bytes)):
        found = _scanner(docs.sparkSession, items, window)(F.col(text_col).cast("string"))
        if k == 0:
            docs = docs.withColumn(out, found)
            continue
        docs = docs.withColumn(out, _merge(F.col(text_col).cast("string"), F.col(out), found))
    c = F.col(out)
    return docs.withColumn(out, c.withField("contaminated", (c["n_hit"] > 0) & (share * c["n_hit"] >= c["n_words"])))


def _merge_arrays(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    rows = []
    for t, a, b in zip(texts.to_pylist(), one.to_pylist(), two.to_pylist(), strict=True):
        t = t or ""
        ranges = a["spans"] + b["spans"]
        hit = np.zeros(a["n_words"], bool)
        if ranges:
            at = np.array([m.start() for m in _WORD.finditer(t)])
            for r in ranges:
                hit[np.searchsorted(at, r["start"]) : np.searchsorted(at, r["end"])] = True
        rows.append({"n_words": a["n_words"], "n_hit": int(hit.sum()), "items": sorted({*a["items"], *b["items"]}), "spans": _original_spans(t, hit) if ranges else []})
    return pa.array(rows, _ARROW)


def _merge(text, one, two):
    return F.arrow_udf(_merge_arrays, _TYPE)(text, one, two)


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Digest rows: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    d = F.col("decontam")
    return decontaminate(docs, benchmark, **options).select(
        "doc_id",
        d["n_words"].alias("n_words"),
        d["n_hit"].alias("n_hit"),
        F.size(d["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(d["items"], ",").cast("binary"), 256).alias("items_sha256"),
        d["contaminated"].alias("contaminated"),
    )
