"""Byte-level BPE as a monoid: halves are encoded on their own and joined where they meet.

Two levels of the same idea. *Pieces* (matches of the pre-token pattern) are cut
in halves; neighbouring halves are joined by encoding a window of tokens around
the seam again, which doubles until the tokens outside of it are proven to stay.
The proof is one of pairs: a sequence of tokens is the encoding of its bytes if,
and only if, each two neighbours are the encoding of theirs (merges of lowest rank,
leftmost first, keep their order when text is cut between final tokens). So only
the two seams of a window have to be looked at.

*Texts* are cut to segments that Spark deals to tasks. A segment's element is its
text before the first and after the last safe place, and the ids between them;
a place before a space or a line feed that follows no white space is safe, since no match
of the pattern reaches over it and none looks beyond it. Joining two elements
encodes the tail of the one with the head of the other; a text without any safe
place grows as text, and is cut in halves as a piece. Decoding puts the bytes of
ids together, segment after segment.

Defined cases: a null text is the empty text and has no ids; repeated rows are
encoded alike; texts of any length and pieces of any length are encoded whole;
an empty table gives no rows; other columns pass through whatever their names.
"""

from __future__ import annotations

import base64
import heapq
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh

#: Bytes of a piece that is merged in one go; longer pieces are cut in halves.
LEAF = 32
#: Characters of a segment; longer texts are dealt to several tasks.
SEGMENT = 1 << 16
#: Distinct pieces and seams that a worker remembers, and the characters of the longest of these pieces.
MEMO, MEMO_BYTES = 1_000_000, 64
#: Ids up to which a plain search for the least rank is faster than a heap.
PLAIN = 512
_NONE = 1 << 62
_SAFE = r"(?<=[^\s\x1c-\x1f])[ \n]"

_coders: dict[tuple, Coder] = {}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Memo(dict):
    """Pieces that a coder has encoded; a new one is encoded when it is first asked for."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        got = self.coder.piece(piece)
        if len(piece) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = got
        return got


class Coder:
    """Encoder and decoder of a file of ranks (base64 of a token's bytes, and its rank, a line)."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.leaf, self.find, self.ranks = leaf, regex.compile(pattern).findall, ranks
        self.first, self.last = regex.compile(_SAFE), regex.compile("(?r)" + _SAFE)
        self.width = max(ranks.values()) + 1
        self.tokens = [b""] * self.width
        for t, k in ranks.items():
            self.tokens[k] = t
        self.single = [ranks.get(bytes([k])) for k in range(256)]
        #: the rank of two tokens' bytes put together, by both ids
        self.pairs = {ranks[t[:i]] * self.width + ranks[t[i:]]: k for t, k in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.two = [self.ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
        self.memo = _Memo(self)
        self.seams: dict[int, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Merges of lowest rank, leftmost first, until there are none."""
        single = self.single
        if len(data) > PLAIN:
            return self._merge_long([single[b] for b in data])
        get, width, two = self.pairs.get, self.width, self.two
        ids = [single[b] for b in data]
        rank = [two[a << 8 | b] for a, b in zip(data, data[1:], strict=False)]
        while rank:
            best = min(rank)
            if best == _NONE:
                break
            i = rank.index(best)
            ids[i] = best
            del ids[i + 1], rank[i]
            if i:
                rank[i - 1] = get(ids[i - 1] * width + best, _NONE)
            if i < len(rank):
                rank[i] = get(best * width + ids[i + 1], _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, width, n = self.pairs.get, self.width, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] * width + ids[j]) != r:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (s := get(r * width + ids[after[j]])) is not None:
                    heapq.heappush(heap, (s, i))
            if before[i] >= 0 and (s := get(ids[before[i]] * width + r)) is not None:
                heapq.heappush(heap, (s, before[i]))
        return [k for k in ids if k >= 0]

    def seam(self, a: int, b: int) -> list[int]:
        """The encoding of two tokens' bytes."""
        key = a * self.width + b
        got = self.seams.get(key)
        if got is None:
            if len(self.seams) >= MEMO:
                self.seams.clear()
            got = self.seams[key] = self.merge(self.tokens[a] + self.tokens[b])
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their bytes."""
        got = self.seam(a, b)
        return len(got) == 2 and got[0] == a

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours; the window doubles on each side that has not settled."""
        if not left or not right:
            return left + right
        middle = self.seam(left[-1], right[0])
        i = j = 1
        while True:
            settled = i >= len(left) or self.fits(left[-i - 1], middle[0]), j >= len(right) or self.fits(middle[-1], right[j])
            if settled[0] and settled[1]:
                return left[: len(left) - i] + middle + right[j:]
            i = i if settled[0] else min(2 * i, len(left))
            j = j if settled[1] else min(2 * j, len(right))
            middle = self.merge(b"".join([self.tokens[t] for t in left[-i:] + right[:j]]))

    def tree(self, data: bytes) -> list[int]:
        """Ids of some bytes by halves; halves end at multiples of the leaf's size, so that long repeats fit."""
        n, leaf = len(data), self.leaf
        if n <= leaf:
            return self.merge(data)
        half = -(-(n // leaf + 1) // 2) * leaf
        half = half if half < n else leaf
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern as little-endian 32-bit integers; a piece that is a token is that token."""
        data = piece.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        return _packed(self.tree(data) if whole is None else [whole])

    def text(self, text: str) -> bytes:
        """Ids of a text, pieces put end to end: nothing is merged over the edge of a piece."""
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def element(self, text: str) -> dict:
        """A segment as head, ids and tail; ids are null where it has no safe place, and all of it is head."""
        a = self.first.search(text)
        if a is None:
            return {"head": text, "ids": None, "tail": ""}
        b = self.last.search(text)
        return {"head": text[: a.start()], "ids": self.text(text[a.start() : b.start()]), "tail": text[b.start() :]}

    def joined(self, a: dict, b: dict) -> dict:
        """Two neighbouring elements as one. A safe place on the very seam is found in what is encoded again."""
        if a["ids"] is None and b["ids"] is None:
            return self.element(a["head"] + b["head"])
        if a["ids"] is None:
            return self._front(a["head"] + b["head"], b)
        if b["ids"] is None:
            return a | {"tail": a["tail"] + b["head"]}
        return {"head": a["head"], "ids": a["ids"] + self.text(a["tail"] + b["head"]) + b["ids"], "tail": b["tail"]}

    def _front(self, text: str, b: dict) -> dict:
        at = self.first.search(text)
        if at is None:
            return b | {"head": text}
        return {"head": text[: at.start()], "ids": self.text(text[at.start() :]) + b["ids"], "tail": b["tail"]}

    def reduce(self, elements: list[dict]) -> bytes:
        """Ids of a document's elements, joined as a balanced tree."""
        while len(elements) > 1:
            odd = elements[len(elements) // 2 * 2 :]
            elements = [self.joined(a, b) for a, b in zip(elements[::2], elements[1::2], strict=False)] + odd
        e = elements[0]
        return self.text(e["head"]) + (e["ids"] or b"") + self.text(e["tail"])

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.tokens[k] for k in np.frombuffer(ids, "<u4").tolist()])


def coder(path: str, pattern: str, leaf: int = LEAF) -> Coder:
    """The coder of a file, built once in a worker."""
    if (key := (path, pattern, leaf)) not in _coders:
        _coders.clear()
        _coders[key] = Coder(path, pattern, leaf)
    return _coders[key]


_ELEMENT = pa.struct([("head", pa.string()), ("ids", pa.binary()), ("tail", pa.string())])
_ELEMENT_SQL = "struct<head:string,ids:binary,tail:string>"


def _udf(work, returns: pa.DataType, sql: str):
    """An Arrow UDF of one column that gives ``work(value)`` for each value."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([work(x.as_py()) for x in column], returns)

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, sql)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of a column of ids (little-endian unsigned 32-bit integers)."""
    return _udf(lambda x: None if x is None else coder(path, pattern).decode(x), pa.binary(), "binary")(ids)


_BOTH = pa.struct([("ids", pa.binary()), ("bytes", pa.binary())])


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", out: str = "ids", segment: int = SEGMENT, leaf: int = LEAF) -> DataFrame:
    """``docs`` with a struct column ``out``: ids, and the bytes that these decode to.

    Texts of at most ``segment`` characters stay where they are. Longer ones are
    cut, equal ones once, and their segments dealt to tasks; the elements of a text
    meet in one aggregate of its own, which holds as much as its row does.
    """
    docs = docs.drop(out)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    k1, k2, no, part = (fresh(docs, n) for n in ("k1", "k2", "seg_no", "part"))
    own = lambda: coder(path, pattern, leaf)
    both = lambda ids: {"ids": ids, "bytes": own().decode(ids)}
    encode = _udf(lambda t: both(own().text(t)), _BOTH, "struct<ids:binary,bytes:binary>")
    cut = _udf(lambda t: [t[i : i + segment] for i in range(0, len(t), segment)], pa.list_(pa.string()), "array<string>")
    element = _udf(lambda t: own().element(t), _ELEMENT, _ELEMENT_SQL)
    reduce = _udf(lambda es: both(own().reduce(es)), _BOTH, "struct<ids:binary,bytes:binary>")

    short = docs.where(F.char_length(text) <= segment)
    long = docs.where(F.char_length(text) > segment).withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    # the cut is made before the rows of equal texts are one, so that whole texts are not shuffled and held together
    parts = long.select(k1, k2, F.posexplode(cut(text)).alias(no, part)).groupBy(k1, k2, no).agg(F.first(part).alias(part))
    rows = parts.select(k1, k2, no, element(F.col(part)).alias("e"))
    whole = rows.groupBy(k1, k2).agg(F.array_sort(F.collect_list(F.struct(no, "e")), lambda a, b: a[no] - b[no]).alias("es"))
    whole = whole.select(k1, k2, reduce(F.transform("es", lambda x: x["e"])).alias(out))
    return short.withColumn(out, encode(text)).unionByName(long.join(whole, [k1, k2]).select(*(F.col(c) for c in docs.columns), out))


def token_digests(spark: SparkSession, docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: the last from the ids, not from the text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    got = encode_documents(spark, rows, path, pattern, out="got", **options).select("doc_id", "got.*")
    return got.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
