"""Connected components and evenly sized groups, as DataFrame operations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (columns u, v); component is the least id.

    Each round hooks every vertex with a smaller neighbour to its least one,
    shortens the chains by joining the hooks with themselves, and relabels the
    edges; so only edges between roots stay. The number of edges falls
    geometrically. Every round is written to the shared folder. Vertices with
    many edges appear only as a key of partial aggregates and of joins with one
    row on the other side, which Spark can split.
    """
    e = edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).where("hi <> lo").distinct()
    e = materialize(spark, e, "edges")
    ids = e.select(F.explode(F.array("hi", "lo")).alias("id")).distinct()
    label = None
    while not e.isEmpty():
        hooks = materialize(spark, e.groupBy("hi").agg(F.min("lo").alias("to")), "hooks")
        while True:
            up = hooks.select(F.col("hi").alias("to"), F.col("to").alias("top"))
            jumped = materialize(spark, hooks.join(up, "to", "left").select("hi", F.coalesce("top", "to").alias("to"), F.col("top").isNotNull().alias("moved")), "hooks")
            hooks = jumped.select("hi", "to")
            if jumped.where("moved").isEmpty():
                break
        if label is None:
            label = ids.join(hooks.withColumnRenamed("hi", "id"), "id", "left").select("id", F.coalesce("to", "id").alias("component"))
        else:
            label = label.join(hooks.withColumnRenamed("hi", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        a, b = hooks.select(F.col("hi"), F.col("to").alias("a")), hooks.select(F.col("hi").alias("lo"), F.col("to").alias("b"))
        e = e.join(a, "hi", "left").join(b, "lo", "left").select(F.coalesce("a", "hi").alias("x"), F.coalesce("b", "lo").alias("y"))
        e = materialize(spark, e.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "edges")
        label = materialize(spark, label, "labels")
    return label if label is not None else ids.select("id", F.col("id").alias("component"))


#: Keys that may be broadcast (with one number each, some MB), and the parts a key's rows are dealt to beyond that.
FEW_KEYS, SALTS = 100_000, 64


def beside(rows: DataFrame, keys: DataFrame, key: str, member: Column) -> DataFrame:
    """``rows`` left-joined with ``keys`` (one row a key) so that no key's rows are dealt to one task.

    ``keys`` must be cheap to count. Up to FEW_KEYS of them are broadcast; more are
    repeated for each of SALTS parts, by which the rows of a key are spread.
    """
    if keys.count() <= FEW_KEYS:
        return rows.join(F.broadcast(keys), key, "left")
    salted = keys.withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("g_salt", F.pmod(F.xxhash64(member, F.lit(3)), F.lit(SALTS)).cast("int"))
    return rows.join(salted, [key, "g_salt"], "left").drop("g_salt")


def tiled(spark: SparkSession, rows: DataFrame, key: Column, member: Column, size: int) -> DataFrame:
    """``rows`` with columns g_key, g_i, g_j and g_side, so that groups of a key fit a task.

    Rows of a key with at most ``size`` rows form one group (0, 0). A larger
    key is cut to tiles by the hash of ``member`` and its rows are repeated for
    each pair of tiles, so every two rows of a key meet in some group of about
    twice ``size`` rows. g_side is 0 for rows of tile g_i, 1 for those of tile g_j.
    Sizes come from a map-side aggregate; only the groups are dealt to tasks, never whole keys.
    """
    rows = rows.withColumn("g_key", key)
    large = rows.groupBy("g_key").agg(F.count(F.lit(1)).alias("g_n")).where(F.col("g_n") > size)
    rows = beside(rows, materialize(spark, large, "large"), "g_key", member)
    tiles = F.coalesce(F.ceil(F.col("g_n") / size), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(7)), F.col("g_t")).cast("int")
    rows = rows.withColumn("g_t", tiles).withColumn("g_own", own)
    rows = rows.withColumn("g_other", F.explode(F.sequence(F.lit(0), F.col("g_t") - 1)))
    return rows.select("*", F.least("g_own", "g_other").alias("g_i"), F.greatest("g_own", "g_other").alias("g_j"), (F.col("g_own") > F.col("g_other")).cast("int").alias("g_side")).drop("g_n", "g_t", "g_own", "g_other")


def meet(spark: SparkSession, rows: DataFrame, large: DataFrame | None, link, partitions: int, *order: str) -> DataFrame:
    """(id, component): the classes that ``link`` finds among rows of equal g_key.

    ``rows`` has g_key, g_tiles (parts to which the rows of the key are cut), g_id
    and what ``link`` needs; ``large`` is the rows of g_tiles > 1, or None if there
    are none. ``link`` is a function for mapInArrow: it gets whole groups (g_key,
    g_i, g_j) and gives (u, v) pairs of members that belong to one class; members of
    equal g_class are of one already.

    First the rows of a tile meet, and with them one member of the whole key: a
    large group of copies is one class after that, at a cost in proportion to its
    rows. Only in keys that still hold several classes do tiles meet each other:
    the rows of the largest class meet all others, but not each other again.
    """
    names = [c for c in rows.columns if c not in ("g_key", "g_tiles", "g_id")]
    h = F.xxhash64("g_id", F.lit(7))
    alone = F.lit(None).cast("long").alias("g_class")

    def met(df: DataFrame) -> DataFrame:
        df = df.select("g_key", "g_i", "g_j", "g_id", "g_class", *names)
        return grouped(df, partitions, *order).mapInArrow(link, "u long, v long")

    def own(df: DataFrame) -> DataFrame:
        i = F.pmod(h, "g_tiles").cast("int")
        return df.select("g_key", i.alias("g_i"), i.alias("g_j"), "g_id", alone, *names)

    first = own(rows)
    if large is not None:
        one = large.groupBy("g_key").agg(F.min_by(F.struct("g_tiles", "g_id", *names), h).alias("p")).select("g_key", "p.*")
        i = F.explode(F.sequence(F.lit(0), F.col("g_tiles") - 1))
        one = one.select("*", i.alias("g_i")).select("g_key", "g_i", F.col("g_i").alias("g_j"), "g_id", alone, *names)
        first = first.unionByName(one)
    classes = connected_components(spark, met(first))
    if large is None:
        return classes
    told = large.join(classes.withColumnRenamed("id", "g_id"), "g_id", "left").withColumn("g_class", F.coalesce("component", "g_id")).drop("component")
    size = told.groupBy("g_key", "g_class").agg(F.count(F.lit(1)).alias("n"), F.max("g_tiles").alias("t"))
    keys = size.groupBy("g_key").agg(F.max_by("g_class", "n").alias("g_most"), F.max("n").alias("g_n"), F.sum("n").alias("g_all"), F.max("t").alias("t")).where("g_n < g_all")
    part = lambda n: F.greatest(F.lit(1), F.ceil(n * F.col("t") / F.col("g_all")).cast("int"))
    keys = materialize(spark, keys.select("g_key", "g_most", part(F.col("g_n")).alias("g_big"), part(F.col("g_all") - F.col("g_n")).alias("g_rest")), "keys")
    if keys.isEmpty():
        return classes
    most = F.col("g_class") == F.col("g_most")
    rest = F.sequence(F.lit(0), F.col("g_rest") - 1)
    mine = F.when(most, -1 - F.pmod(h, "g_big")).otherwise(F.pmod(h, "g_rest")).cast("int")
    other = F.when(most, rest).otherwise(F.concat(F.sequence(-F.col("g_big"), F.lit(-1)), rest))
    again = told.join(keys, "g_key").withColumn("g_own", mine).withColumn("g_other", F.explode(other))
    again = again.withColumn("g_i", F.least("g_own", "g_other")).withColumn("g_j", F.greatest("g_own", "g_other"))
    known = classes.select(F.col("id").alias("u"), F.col("component").alias("v"))
    return connected_components(spark, met(again).unionByName(known))


def known_classes(place: np.ndarray, classes: np.ndarray, mask: np.ndarray, forest: Forest) -> None:
    """Unite in ``forest`` the places of rows of one class; ``mask`` tells which rows have one."""
    rows = np.flatnonzero(mask)
    if len(rows):
        _, first, inverse = np.unique(classes[rows], return_index=True, return_inverse=True)
        forest.union_pairs(place[rows], place[rows[first[inverse]]])


def grouped(rows: DataFrame, partitions: int, *order: str) -> DataFrame:
    """Rows of a group beside each other, groups spread over ``partitions`` tasks."""
    return rows.repartition(partitions, "g_key", "g_i", "g_j").sortWithinPartitions("g_key", "g_i", "g_j", *order)


def group_runs(batches, keys: tuple[str, ...] = ("g_key", "g_i", "g_j")):
    """The groups in a stream of sorted record batches, each as one table.

    Only the current group is held. Groups of one row are given too.
    """
    import pyarrow as pa

    held: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        cuts = [*np.flatnonzero(change), batch.num_rows]
        at = 0
        for k, cut in enumerate(cuts):
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if k < len(cuts) - 1:
                if held:
                    yield pa.Table.from_batches(held)
                held = []
            at = cut
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over positions; roots are least positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            nxt = self.up[self.up]
            if (nxt == self.up).all():
                return self.up
            self.up = nxt

    def union_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the classes of many pairs at once, by repeated hooking of roots."""
        while len(a):
            r = self.roots()
            x, y = r[a], r[b]
            far = x != y
            if not far.any():
                return
            a, b, x, y = a[far], b[far], x[far], y[far]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
