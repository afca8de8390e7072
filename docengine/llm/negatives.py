"""Hard negatives by exact inner products over buckets of vectors sorted by norm.

Vectors become whole numbers, are sorted by squared norm and packed to buckets of
some megabytes, one row each. Buckets are dealt to slices and anchors, sorted and packed
alike, to blocks; a task meets one block with the buckets of one slice, largest norms first.
By the Cauchy-Schwarz inequality no vector of a bucket scores above the product of
the anchor's and the bucket's largest norm: a bucket is passed over for all anchors whose lower
limit, that of their window or their running k-th score, lies above that. Two rounds:
an anchor's positives, and from their scores the windows in which its negatives lie.
Pairs of block and bucket that no window can reach are not dealt at all in the second.

Scores are exact: products of whole numbers are summed in doubles where all sums
stay below 2^53, else in Python's integers.

Defined cases: a row whose id, label or vector is null, or that has a null or
non-finite component, takes no part; equal rows are one; rows of one id with
different labels or vectors each take part, but are never positives or negatives of each other;
vectors of other lengths do not meet; a vector without components scores 0; scores beyond 64 bits
become the largest (least) long; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import FEW_KEYS, SALTS
from .shared import materialize

#: Positives of an anchor, negatives of a positive; percents of a positive's score that bound its window.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Bytes of a bucket's vectors and of a block's anchors; rows of them at most; buckets that meet a block in one task.
BUCKET_BYTES, BUCKET_ROWS, BLOCK_ROWS, SLICE_BUCKETS = 2 << 20, 4096, 512, 32
#: Doubles hold all whole numbers up to here.
EXACT = float(1 << 53)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_PACKED = "dim int, ids binary, row_keys binary, labels binary, vectors binary, top double, first_key long"
_TOP = "row_key long, anchor_id long, slot int, score long, other_id long"


def usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, label: Column | None = None, scale: int = 256) -> DataFrame:
    """(id, label, v, dim, row_key, size) of the rows that take part, once each; v holds whole numbers as doubles."""
    v = F.transform(F.col(vector_col), lambda x: _floor(x.cast("double") * scale))
    fine = F.forall(F.col(vector_col), lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != math.inf), F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), v.alias("v")).distinct()
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return rows.select("*", F.size("v").alias("dim"), F.xxhash64("id", "label", "v").alias("row_key"), size.alias("size"))


def _floor(x: Column) -> Column:
    """Floor of a double as a double: from 2^53 on doubles are whole already, and longs would end at 2^63."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def packed(spark: SparkSession, rows: DataFrame, most: int, name: str) -> DataFrame:
    """``rows`` sorted by length and norm, largest first, as one row for each bucket of at most ``most`` vectors."""

    def pack(batches):
        held: list = []
        count = 0

        def give(table):
            dim = table.column("dim")[0].as_py()
            v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, dim)
            ids, keys, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("id", "row_key", "label"))
            top = math.nextafter(math.sqrt(table.column("size").to_numpy().max()) * (1 + 1e-9), math.inf)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, keys, labels, v)), pa.array([top]), pa.array([int(keys[0])])], ["dim", "ids", "row_keys", "labels", "vectors", "top", "first_key"])

        for batch in batches:
            at = 0
            dims = batch.column("dim").to_numpy()
            while at < len(dims):
                if held and held[0].column("dim")[0].as_py() != dims[at]:
                    yield give(pa.Table.from_batches(held))
                    held, count = [], 0
                limit = max(1, min(most, BUCKET_BYTES // max(8, 8 * int(dims[at]))))
                same = int(np.argmax(np.append(dims[at:] != dims[at], True)))
                n = min(same, limit - count)
                if n:
                    held.append(batch.slice(at, n))
                    at, count = at + n, count + n
                if count >= limit:
                    yield give(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            yield give(pa.Table.from_batches(held))

    order = [F.col("dim"), F.col("size").desc(), F.col("id"), F.col("row_key")]
    return materialize(spark, rows.orderBy(*order).mapInArrow(pack, _PACKED), name)


def _matrix(row: dict) -> tuple:
    ids, keys, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "row_keys", "labels"))
    return ids, keys, labels, np.frombuffer(row["vectors"], np.float64).reshape(len(ids), row["dim"]), row["top"]


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of whole numbers held as doubles; ``bound`` is above all sums of their absolute values."""
    if bound < EXACT:
        return a @ b.T
    whole = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape)
    other = np.array([[int(x) for x in r] for r in b], object).reshape(b.shape)
    got = whole @ other.T if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(got, _LEAST, _MOST)


class _Tops:
    """The k best (score, id) of each of n windows, so far."""

    def __init__(self, n: int, k: int, low):
        self.n, self.k = n, k
        self.low = low  # of each window: no score below it is wanted
        self.best: list[list[tuple]] = [[] for _ in range(n)]
        self.kth = list(low)

    def take(self, which: np.ndarray, scores, ids: np.ndarray) -> None:
        """Entries by window, in any order."""
        if not len(which):
            return
        order = np.lexsort((ids, [-int(s) for s in scores] if scores.dtype == object else -scores, which))
        cuts = np.flatnonzero(np.append(True, np.diff(which[order]) != 0))
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            w, head = int(which[order[a]]), order[a : min(b, a + self.k)]
            merged = sorted([*self.best[w], *((-int(scores[i]), int(ids[i])) for i in head)])[: self.k]
            self.best[w] = merged
            if len(merged) == self.k:
                self.kth[w] = max(self.low[w], -merged[-1][0])


def _wanted(scores: np.ndarray, allowed: np.ndarray, kth: np.ndarray, k: int) -> np.ndarray:
    """Places of the entries that can be among the k best of their rows: all those of the k-th score too."""
    mask = allowed & (scores >= kth[:, None])
    if scores.dtype != object and mask.sum() > 8 * k * len(scores) and scores.shape[1] > k:
        held = np.where(mask, scores, -np.inf)
        mask &= scores >= np.partition(held, -k, axis=1)[:, -k][:, None]
    return mask


def _search(windows: bool):
    """A function for mapInArrow over (block, slice, kind, ...): the block's anchors, then buckets of falling norm."""

    def run(batches):
        held = None
        for row in (r for batch in batches for r in batch.to_pylist()):
            key = row["block"], row["slice"]
            if held is None or held["key"] != key:
                if held is not None:
                    yield _tops(held)
                held = {"key": key, "anchors": None}
            if row["kind"] == 0:
                held |= _block(row, windows)
            else:
                _meet(held, row)
        if held is not None:
            yield _tops(held)

    return run


def _block(row: dict, windows: bool) -> dict:
    ids, keys, labels, v, top = _matrix(row)
    size = np.sqrt((v * v).sum(axis=1)) * (1 + 1e-9)
    if not windows:
        which, low, high = np.arange(len(ids)), [_LEAST] * len(ids), None
        k = POSITIVES
    else:
        which = np.frombuffer(row["window_of"], np.int64)
        low, high, k = np.frombuffer(row["low"], np.int64).tolist(), np.frombuffer(row["high"], np.int64), NEGATIVES
    return {"anchors": (ids, keys, labels, v, size, top), "which": which, "high": high, "tops": _Tops(len(which), k, low), "same": not windows, "slots": np.frombuffer(row["slots"], np.int64) if windows else np.zeros(len(ids), np.int64)}


def _meet(held: dict, row: dict) -> None:
    ids, keys, labels, v, size, top = held["anchors"]
    other, _, other_labels, w, other_top = _matrix(row)
    tops, which = held["tops"], held["which"]
    # an anchor is out for this bucket if its lower limit, or its k-th score, is above all that the bucket can give
    kth = np.array([float(x) for x in tops.kth])
    with np.errstate(invalid="ignore"):
        open_windows = np.flatnonzero(~(size[which] * other_top * (1 + 1e-9) < kth))  # nothing times infinity is no bound
    if not len(open_windows):
        return
    rows = np.unique(which[open_windows])
    scores = products(v[rows], w, float(size[rows].max() * other_top))
    same = labels[rows][:, None] == other_labels[None, :]
    allowed = (same if held["same"] else ~same) & (ids[rows][:, None] != other[None, :])
    at = np.searchsorted(rows, which[open_windows])
    step = max(1, (1 << 22) // max(1, len(other)))
    for a in range(0, len(open_windows), step):
        part, here = open_windows[a : a + step], at[a : a + step]
        s, ok = scores[here], allowed[here]
        if held["high"] is not None:
            ok = ok & (s <= held["high"][part][:, None])
        limit = np.array([tops.kth[i] for i in part], object if s.dtype == object else np.float64)
        r, c = np.nonzero(_wanted(s, ok, limit, tops.k))
        tops.take(part[r], s[r, c], other[c])


def _tops(held: dict) -> pa.RecordBatch:
    ids, keys = held["anchors"][:2]
    out = [(int(keys[a]), int(ids[a]), slot, -s, i) for a, slot, best in zip(held["which"].tolist(), held["slots"].tolist(), held["tops"].best, strict=True) for s, i in best]
    columns = list(zip(*out, strict=True)) or [[]] * 5
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["row_key", "anchor_id", "slot", "score", "other_id"])


def _met(blocks: DataFrame, buckets: DataFrame, slices: int, partitions: int, windows: bool) -> DataFrame:
    """Tops of all blocks over all slices: each block meets the buckets of each slice in one task."""
    none = {c: F.lit(None).cast("binary").alias(c) for c in ("window_of", "low", "high", "slots")}
    extra = [F.col(c) if windows else none[c] for c in none]
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    left = blocks.select(F.col("first_key").alias("block"), "dim", "ids", "row_keys", "labels", "vectors", "top", *extra, *(["least"] if windows else []))
    right = buckets.select("dim", F.pmod("first_key", F.lit(slices)).cast("int").alias("slice"), "ids", "row_keys", "labels", "vectors", "top")
    some = left.select("block", "dim", F.col("top").alias("b_top"), F.col("least") if windows else F.lit(-math.inf).alias("least"))
    # every bucket goes to the blocks of its length that it can score for
    dealt = _beside(right, some).where(F.col("b_top") * F.col("top") >= F.col("least")).select("block", "slice", F.lit(1).alias("kind"), "dim", "ids", "row_keys", "labels", "vectors", "top", *none.values())
    own = left.select("block", every, F.lit(0).alias("kind"), "dim", "ids", "row_keys", "labels", "vectors", "top", *extra)
    rows = own.unionByName(dealt).repartition(partitions, "block", "slice").sortWithinPartitions("block", "slice", "kind", F.desc("top"))
    found = rows.mapInArrow(_search(windows), _TOP)
    k = NEGATIVES if windows else POSITIVES
    w = Window.partitionBy("row_key", "anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _beside(buckets: DataFrame, some: DataFrame) -> DataFrame:
    """``buckets`` with the few numbers of each block of their length: broadcast while there are few blocks, else joined in parts."""
    if some.count() <= FEW_KEYS:
        return buckets.join(F.broadcast(some), "dim")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return buckets.select("*", salts).join(some.withColumn("salt", F.pmod("block", F.lit(SALTS)).cast("int")), ["dim", "salt"]).drop("salt")


def hard_negatives(spark: SparkSession, vectors: DataFrame, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", label: Column | None = None, anchor: Column | None = None, scale: int = 256, block_rows: int = BLOCK_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``, a condition on ``id``, chooses the anchors; ``label`` may replace the labels.
    """
    rows = materialize(spark, usable(vectors, id_col, label_col, vector_col, label, scale), "vectors")
    anchors = rows if anchor is None else rows.where(anchor)
    buckets, blocks = packed(spark, rows, bucket_rows, "buckets"), packed(spark, anchors, block_rows, "blocks")
    slices = max(1, -(-buckets.count() // SLICE_BUCKETS), min(4, buckets.count()))
    tasks = max(spark.sparkContext.defaultParallelism, min(10_000, slices * blocks.count()))
    positives = materialize(spark, _met(blocks, buckets, slices, tasks, False).select("row_key", "anchor_id", F.col("rank").alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    found = _met(with_windows(blocks, positives), buckets, slices, tasks, True)
    chosen = found.select("row_key", "anchor_id", "slot", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return chosen.join(positives, ["row_key", "anchor_id", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def with_windows(blocks: DataFrame, positives: DataFrame) -> DataFrame:
    """``blocks`` with the windows of their anchors as arrays, and the least lower limit of each block."""
    p = F.col("positive_score")
    # 50 p <= 100 n <= 95 p has no solution below 0; division of whole numbers, rounded up and down
    low = F.expr(f"CAST(({LOW} * CAST(positive_score AS DECIMAL(38,0)) + 99) div 100 AS LONG)")
    high = F.expr(f"CAST(({HIGH} * CAST(positive_score AS DECIMAL(38,0))) div 100 AS LONG)")
    windows = positives.where(p >= 0).select("row_key", F.struct("row_key", "slot", low.alias("low"), high.alias("high")).alias("w"))
    keys = blocks.select("first_key", F.explode(_longs(F.col("row_keys"))).alias("row_key"))
    of = keys.join(windows, "row_key").groupBy("first_key").agg(F.collect_list("w").alias("ws"))

    def lay(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at = {k: i for i, k in enumerate(np.frombuffer(r["row_keys"], np.int64).tolist())}
                ws = sorted(r["ws"], key=lambda w: (at[w["row_key"]], w["slot"]))
                column = lambda f, ws=ws: np.array([f(w) for w in ws], np.int64).tobytes()
                low = [w["low"] for w in ws]
                out.append(r | {"window_of": column(lambda w, at=at: at[w["row_key"]]), "low": column(lambda w: w["low"]), "high": column(lambda w: w["high"]), "slots": column(lambda w: w["slot"]), "least": float(min(low))})
                del out[-1]["ws"]
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("dim", pa.int32()), *((c, pa.binary()) for c in ("ids", "row_keys", "labels", "vectors")), ("top", pa.float64()), ("first_key", pa.int64()), *((c, pa.binary()) for c in ("window_of", "low", "high", "slots")), ("least", pa.float64())])
    return blocks.join(of, "first_key").select("dim", "ids", "row_keys", "labels", "vectors", "top", "first_key", "ws").mapInArrow(lay, _PACKED + ", window_of binary, low binary, high binary, slots binary, least double")


def _longs(packed_longs: Column) -> Column:
    """The 64-bit integers of a binary column."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x.as_py(), np.int64).tolist() for x in column], pa.list_(pa.int64()))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<bigint>")(packed_longs)


def negatives_report(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """The anchors are rows whose id is divisible by 50; every seventh id has another label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark, embeddings, label=label, anchor=F.col("id") % 50 == 0)
