"""Ranked lexical search over a clustered index of documents that graph bisection has put in order.

Order: the graph of documents and terms is cut in two again and again, moving
documents between the halves while that shortens the gaps of posting lists. This is fitted on a
bounded sample; every document then goes down the tree of cuts by what its terms
weigh on each side, so that documents of like terms share a cluster. Clusters are cut
to shards of bounded size, one row each, with packed posting lists.

Search: for each shard and term the greatest contribution of any document is kept, and a
query's bound for a shard is their weighted sum. A query first visits the shards
of its highest bounds, and then every other shard whose bound is not below the
score of its k-th document. What is left cannot hold a document of the result, so the result is exact whatever
the order; shards with a bound equal to that score are visited, since ties go by doc_id.

Only posting lists of terms that may be asked for are kept: a table of bits of bounded
size, by the terms' hashes, goes to the tasks. Terms are 64-bit hashes; two different
ones among n are taken for one with a chance of about n^2 / 2^65.

Defined cases: a null or empty text has no terms, is in no result and is not counted in N;
each row is a document of its own, so repeated rows are listed each; rows of a null
doc_id come after others of their score; equal rows of items are one; an item without terms, or of whose terms none
occurs, has no result; texts of any length are read whole; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialize, string_buffers, tasks_for
from .textkit import U64, mix, span_hashes, words

K = 10
#: Documents and terms of each that the order is fitted on; levels of cuts; passes over a cut; terms that a cut weighs.
SAMPLE, SAMPLE_TERMS, LEVELS, PASSES, NODE_TERMS = 2048, 512, 5, 12, 4096
#: Documents and posting entries of a shard; shards of a query's first round.
SHARD_DOCS, SHARD_ENTRIES, FIRST = 4096, 1 << 20, 8
#: Least and most bits of the table of wanted terms; between them it has 64 for each term.
TERM_BITS = (18, 27)
#: Bits that one row of Spark's bitmap functions holds.
_BITMAP = 32768

#: Bytes that are not part of a term: all of ASCII but digits and letters.
NO_TERM = np.zeros(256, bool)
NO_TERM[:128] = [not chr(c).isalnum() for c in range(128)]

_DOCS = "doc_id long, n long, leaf int, place float, terms binary, tfs binary"
_SHARD = "shard long, leaf int, n_docs long, n_terms long, n_with_terms long, doc_ids binary, named binary, sizes binary, terms binary, edges binary, places binary, tfs binary"


# --- terms ---------------------------------------------------------------------------


def entries(texts, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each document, document numbers, hashes, occurrences), the last three by document and hash."""
    raw, off = string_buffers(texts)
    starts, ends, docs, data = words(raw, off, NO_TERM)
    h = span_hashes(data, starts, ends)
    n = np.bincount(docs, minlength=len(off) - 1)
    if wanted is not None:
        ok = _is_wanted(h, wanted)
        h, docs = h[ok], docs[ok]
    order = np.lexsort((h, docs))
    h, docs = h[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (docs[1:] != docs[:-1])
    first = np.flatnonzero(new)
    return n, docs[first], h[first], np.diff(np.append(first, len(h)))


def _is_wanted(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    slot = h >> U64(64 - (len(table).bit_length() + 2))  # the table has 2^k bits, in bytes
    return (table[(slot >> U64(3)).astype(np.int64)] >> (slot & U64(7)).astype(np.uint8)) & 1 == 1


def wanted_terms(terms: DataFrame, column: str = "term") -> np.ndarray:
    """A table of bits by the first bits of the hash, set for every term: at most 16 MB, whatever the number of terms."""
    bits = min(max((64 * terms.count()).bit_length(), TERM_BITS[0]), TERM_BITS[1])
    slot = F.shiftrightunsigned(column, 64 - bits) + 1
    rows = terms.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")).collect()
    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        at = (r["b"] - 1) * _BITMAP // 8
        table[at : at + _BITMAP // 8] = np.frombuffer(r["bits"], np.uint8)
    return table


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term, times): a row for each term of each different item."""

    def run(batches):
        for b in batches:
            _, d, h, tf = entries(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(d)), b.column("item_id").take(pa.array(d)), pa.array(h.astype(np.int64)), pa.array(tf.astype(np.int64))], ["item", "item_id", "term", "times"])

    kind = dict(items.dtypes)[id_col]
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    return rows.mapInArrow(run, f"item long, item_id {kind}, term long, times long")


# --- order ---------------------------------------------------------------------------


def _cost(d: np.ndarray, n: int) -> np.ndarray:
    """Bits of the gaps of lists of d documents among n, as the bisection counts them."""
    return d * np.log2(n / (d + 1.0))


def bisect(doc: np.ndarray, term: np.ndarray, n: int, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sides (0 or 1) of n documents, and the degrees of each term on both, after swaps that shorten the lists.

    ``doc`` and ``term`` are the edges of the graph. Each pass sorts the documents of
    both halves by what their move gains and swaps pairs while the sum is positive.
    """
    terms = int(term.max()) + 1 if len(term) else 0
    half = n // 2
    side = (np.arange(n) >= half).astype(np.int64)
    left, right = half, n - half
    for _ in range(passes):
        on = side[doc] == 1
        dr = np.bincount(term[on], minlength=terms)
        dl = np.bincount(term, minlength=terms) - dr
        now = _cost(dl, left) + _cost(dr, right)
        to_right = now - _cost(np.maximum(dl - 1, 0), left) - _cost(dr + 1, right)
        to_left = now - _cost(dl + 1, left) - _cost(np.maximum(dr - 1, 0), right)
        gain = np.bincount(doc, weights=np.where(on, to_left[term], to_right[term]), minlength=n)
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swaps = int(np.argmin(np.append(gain[a[:m]] + gain[b[:m]] > 1e-9, False)))
        if not swaps:
            break
        side[a[:swaps]], side[b[:swaps]] = 1, 0
    dr = np.bincount(term[side[doc] == 1], minlength=terms)
    return side, np.bincount(term, minlength=terms) - dr, dr


def _threshold(score: np.ndarray, side: np.ndarray) -> float:
    """The score from which on documents go left, so that most of them stay on the side they were put on."""
    order = np.argsort(-score, kind="stable")
    s, right = score[order], side[order]
    same = np.cumsum(right == 0) + right.sum() - np.cumsum(right)
    ends = np.flatnonzero(np.diff(s) < 0)  # a cut is between two different scores
    if not len(ends):
        return -np.inf
    at = ends[np.argmax(same[ends])]
    return (s[at] + s[at + 1]) / 2


class Order:
    """The tree of cuts: what each term weighs at each cut, and the weight from which a document goes left."""

    def __init__(self, doc: np.ndarray, h: np.ndarray, n: int, levels: int = LEVELS):
        self.levels = levels
        self.least = np.zeros(1 << levels)
        self.share = np.zeros(1 << levels)
        keys, weights = [], []
        nodes = {1: np.arange(n)}
        for level in range(levels + 1):
            below: dict[int, np.ndarray] = {}
            for node, members in nodes.items():
                if level == levels or len(members) < 2:
                    self.share[(node << (levels - level)) - (1 << levels)] += len(members) / max(1, n)
                    continue
                place = np.full(n, -1)
                place[members] = np.arange(len(members))
                mine = place[doc] >= 0
                d, (known, t) = place[doc[mine]], np.unique(h[mine], return_inverse=True)
                side, dl, dr = bisect(d, t, len(members))
                nl, nr = len(members) // 2, len(members) - len(members) // 2
                w = np.log2((dl + 1) / (nl + 1)) - np.log2((dr + 1) / (nr + 1))
                top = np.argsort(-np.abs(w) * np.sqrt(dl + dr), kind="stable")[:NODE_TERMS]
                kept = np.zeros(len(known))
                kept[top] = w[top]
                score = np.bincount(d, weights=kept[t], minlength=len(members))
                self.least[node] = _threshold(score, side)
                left = score >= self.least[node]
                keys.append(_at_node(known[top], node))
                weights.append(w[top])
                below |= {2 * node: members[left], 2 * node + 1: members[~left]}
            nodes = {k: v for k, v in below.items() if len(v)}
        keys, weights = np.concatenate([np.zeros(0, U64), *keys]), np.concatenate([np.zeros(0), *weights])
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order].astype(np.float32)

    def places(self, doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each of n documents, and its weight at the last cut, by which documents of a leaf are in order."""
        node, score = np.ones(n, np.int64), np.zeros(n)
        for _ in range(self.levels):
            if len(self.keys):
                key = _at_node(h, node[doc])
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                score = np.bincount(doc, weights=np.where(self.keys[at] == key, self.weights[at], 0), minlength=n)
            node = 2 * node + (score < self.least[node])
        return (node - (1 << self.levels)).astype(np.int32), score.astype(np.float32)


def _at_node(h: np.ndarray, node) -> np.ndarray:
    return h ^ mix(np.atleast_1d(node).astype(U64) * U64(0x9E3779B97F4A7C15))


def fit_order(docs: DataFrame, wanted, rows: int, levels: int = LEVELS) -> Order:
    """The tree fitted on about SAMPLE documents, of each the terms of least hash: results never depend on it."""

    def run(batches):
        for b in batches:
            n, d, h, _ = entries(b.column("text"), wanted.value)
            first = np.searchsorted(d, np.arange(len(n)))
            ok = np.arange(len(d)) - first[d] < SAMPLE_TERMS
            yield pa.RecordBatch.from_arrays([_binary(h[ok], d[ok], len(n))], ["terms"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(max(1, rows))) < SAMPLE).mapInArrow(run, "terms binary").limit(2 * SAMPLE)
    got = [np.frombuffer(x, U64) for x in some.toArrow().column("terms").to_pylist()]
    got = sorted((x for x in got if len(x)), key=lambda x: x.tobytes())  # whatever the order of tasks
    doc = np.repeat(np.arange(len(got)), [len(x) for x in got]).astype(np.int64)
    return Order(doc, np.concatenate([np.zeros(0, U64), *got]), len(got), levels)


# --- index ---------------------------------------------------------------------------


def _binary(values: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    """The values of each of n documents (ascending in ``doc``) as a binary column."""
    edge = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32) * values.dtype.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(edge.tobytes()), pa.py_buffer(values.tobytes())])


def _small(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes of 1, 2, 4 or 8, after a byte that tells how many."""
    most = int(x.max()) if len(x) else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << (8 * s - 1))
    return bytes([size]) + x.astype(f"<i{size}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def build_index(spark: SparkSession, docs: DataFrame, terms: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_entries: int = SHARD_ENTRIES, levels: int = LEVELS) -> DataFrame:
    """Shards of all documents (schema _SHARD), with the posting lists of ``terms`` (a column term of hashes)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = docs.count()
    wanted = spark.sparkContext.broadcast(wanted_terms(terms))
    order = fit_order(docs, wanted, rows, levels)
    held = spark.sparkContext.broadcast(order)

    def tokenise(batches):
        for b in batches:
            n, d, h, tf = entries(b.column("text"), wanted.value)
            leaf, place = held.value.places(d, h, len(n))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(leaf), pa.array(place), _binary(h, d, len(n)), _binary(tf.astype("<u4"), d, len(n))], ["doc_id", "n", "leaf", "place", "terms", "tfs"])

    # leaves are dealt in parts of about a shard, by their share of the sample
    parts = F.element_at(F.array(*(F.lit(int(-(-rows * max(s, 1e-3) // shard_docs)) or 1) for s in order.share)), F.col("leaf") + 1)
    part = F.pmod(F.xxhash64("doc_id", "n", F.lit(5)), parts)
    dealt = docs.mapInArrow(tokenise, _DOCS).withColumn("part", part).repartition(tasks_for(spark, rows, 4 * shard_docs), "leaf", "part")
    dealt = dealt.sortWithinPartitions("leaf", "part", "place", "doc_id")

    def pack(batches):
        state: dict = {"rows": [], "entries": 0, "leaf": None}
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("leaf", "doc_id", "n", "terms", "tfs")]
            for leaf, *row in zip(*columns, strict=True):
                size = len(row[2]) // 8
                full = len(state["rows"]) >= shard_docs or state["entries"] + size > shard_entries
                if state["rows"] and (full or leaf != state["leaf"]):
                    yield _shard(state)
                    state = {"rows": [], "entries": 0, "leaf": None}
                state["rows"].append(row)
                state["entries"] += size
                state["leaf"] = leaf
        if state["rows"]:
            yield _shard(state)

    return materialize(spark, dealt.select(*(x.split()[0] for x in _DOCS.split(", "))).mapInArrow(pack, _SHARD), "shards")


def _shard(state: dict) -> pa.RecordBatch:
    """One row of a shard: posting lists by term, each of document places and occurrences."""
    import uuid

    ids, n, terms, tfs = zip(*state["rows"], strict=True)
    size = [len(x) // 8 for x in terms]
    h, tf = np.frombuffer(b"".join(terms), U64), np.frombuffer(b"".join(tfs), "<u4")
    doc = np.repeat(np.arange(len(ids)), size)
    order = np.argsort(h, kind="stable")
    known, first = np.unique(h[order], return_index=True)
    row = {
        "shard": uuid.uuid4().int >> 65, "leaf": state["leaf"], "n_docs": len(ids), "n_terms": sum(n), "n_with_terms": sum(x > 0 for x in n),
        "doc_ids": np.array([0 if x is None else x for x in ids], np.int64).tobytes(), "named": np.array([x is not None for x in ids]).tobytes(),
        "sizes": _small(np.array(n, np.int64)), "terms": known.tobytes(), "edges": _small(np.append(first, len(h))), "places": _small(doc[order]), "tfs": _small(tf[order].astype(np.int64)),
    }
    kinds = {"leaf": pa.int32()} | dict.fromkeys(("shard", "n_docs", "n_terms", "n_with_terms"), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()], list(row))


class Shard:
    """A shard's lists in memory, with what each entry gives to a score before the term's weight."""

    def __init__(self, row: dict, n: int, total: int):
        self.ids, self.named = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["named"], bool)
        self.terms, self.edges, self.doc = np.frombuffer(row["terms"], U64), _large(row["edges"]), _large(row["places"])
        length = 25 + 75 * _large(row["sizes"]) * n // max(1, total)
        tf = _large(row["tfs"])
        self.gives = 1_000_000_000 * tf // (1000 * tf + 8 * length[self.doc])

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> np.ndarray:
        """Places of the documents that can be among the k best of those with a score of ``least`` and more, and all scores."""
        score = np.zeros(len(self.ids), np.int64)
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
            for i in np.flatnonzero(self.terms[at] == terms):
                span = slice(self.edges[at[i]], self.edges[at[i] + 1])
                score[self.doc[span]] += weights[i] * self.gives[span]
        found = np.flatnonzero(score >= max(1, least))
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], -k)[-k]]
            found = found[np.lexsort((self.ids[found], ~self.named[found], -score[found]))[:k]]
        return found, score


# --- search --------------------------------------------------------------------------


def _term_bounds(shards: DataFrame, n: int, total: int) -> DataFrame:
    """(term, shard, df, most): documents of a shard that hold a term, and the most that one of them gives."""

    def run(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            s = Shard(row, n, total)
            if len(s.terms):
                yield pa.RecordBatch.from_arrays([pa.array(s.terms.astype(np.int64)), pa.array(np.full(len(s.terms), row["shard"])), pa.array(np.diff(s.edges)), pa.array(np.maximum.reduceat(s.gives, s.edges[:-1]))], ["term", "shard", "df", "most"])

    return shards.mapInArrow(run, "term long, shard long, df long, most long")


def _visit(spark: SparkSession, shards: DataFrame, visits: DataFrame, queries: DataFrame, n: int, total: int, k: int, tasks: int) -> DataFrame:
    """(item, score, doc_id) of the best of each visited shard; ``visits`` has item, shard and least."""

    def run(batches):
        shard, at = None, None
        for row in (r for b in batches for r in b.to_pylist()):
            if row["kind"] == 0:
                shard, at = Shard(row, n, total), row["shard"]
                continue
            assert at == row["shard"], "a query without its shard"
            terms, weights = (np.array([x[c] for x in row["ask"]], np.int64) for c in ("term", "weight"))
            found, score = shard.top(terms.astype(U64), weights, k, row["least"])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row["item"])), pa.array(score[found]), pa.array(shard.ids[found], mask=~shard.named[found])], ["item", "score", "doc_id"])

    index = [x.split()[0] for x in _SHARD.split(", ")]
    left = shards.join(visits.select("shard").distinct(), "shard", "left_semi").select("shard", F.lit(0).alias("kind"), *(c for c in index if c != "shard"), F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("least"), F.lit(None).cast("array<struct<term:bigint,weight:bigint>>").alias("ask"))
    right = visits.join(queries, "item").select("shard", F.lit(1).alias("kind"), *(F.lit(None).cast(t).alias(c) for c, t in shards.dtypes if c != "shard"), "item", "least", "ask")
    return left.unionByName(right).repartition(tasks, "shard").sortWithinPartitions("shard", "kind").mapInArrow(run, "item long, score long, doc_id long")


def search(spark: SparkSession, shards: DataFrame, items: DataFrame, *, k: int = K, first: int = FIRST) -> DataFrame:
    """(item_id, rank, doc_id, score) for ``items``, the rows of ``item_terms``."""
    s = shards.agg(F.count(F.lit(1)).alias("shards"), F.sum("n_with_terms").alias("n"), F.sum("n_terms").alias("total")).first()
    n, total = s["n"] or 0, s["total"] or 0
    tasks = tasks_for(spark, s["shards"], 8)
    bounds = materialize(spark, _term_bounds(shards, n, total).join(items.select("term").distinct(), "term", "left_semi"), "term_bounds")
    held = bounds.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = materialize(spark, items.join(held, "term").select("item", "item_id", "term", (weight * F.col("times")).alias("weight")), "weights")
    queries = weighted.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("ask"))
    of = materialize(spark, weighted.join(bounds, "term").groupBy("item", "shard").agg(F.sum(F.col("weight") * F.col("most")).alias("bound")), "bounds").where("bound > 0")

    nearest = Window.partitionBy("item").orderBy(F.desc("bound"), "shard")
    early = of.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= first)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    found = materialize(spark, top(_visit(spark, shards, early.select("item", "shard", F.lit(1).cast("long").alias("least")), queries, n, total, k, tasks)).select("item", "score", "doc_id"), "first")
    kth = found.groupBy("item").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(1).cast("long").alias("least"))
    rest = of.join(early.select("item", "shard"), ["item", "shard"], "left_anti").join(kth, "item", "left").withColumn("least", F.coalesce("least", F.lit(1)))
    rest = materialize(spark, rest.where("bound >= least").select("item", "shard", "least"), "visits")
    found = found.unionByName(_visit(spark, shards, rest, queries, n, total, k, tasks))
    names = items.select("item", "item_id").distinct()
    return top(found).join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text", k: int = K, first: int = FIRST, **index) -> DataFrame:
    """The k best documents of each item: the index is made of ``docs`` for the items' terms, and searched."""
    items = materialize(spark, item_terms(benchmark, id_col, text_col), "items")
    return search(spark, build_index(spark, docs, items.select("term").distinct(), **index), items, k=k, first=first)
