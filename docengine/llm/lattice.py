"""Embedding near-duplicates by E8 lattice hashing.

Vectors are projected to two blocks of eight dimensions in each of several
tables; each block is decoded to its nearest point of the E8 lattice, and the
pair of points is the cell. A vector is stored in its own cell and looks into
the cells next to it (lattice neighbours, nearest first). In a cell, small
integer copies of the vectors select candidates a little below the wanted
cosine; only a spanning forest of them leaves the task. The groups this gives
are then compared exactly in double precision, whole groups at a time, which
yields every link inside them without writing the links out.

Cells are first dealt without copies: a row of (cell, id) for each probe. Only rows
of cells where somebody meets a stored vector get a copy and are dealt again. Small
cells of a batch are compared at once; large cells are cut to tiles whose pairs are
separate tasks, as are large groups.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components links with nothing; vectors of different lengths never link; equal
vectors are compared once and counted as often as they occur, so that each row is a vector of its
own and a link of the rows that repeat it; rows of one id with other vectors have each their own links and component; rows with a null
id take part and get a null component when alone; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import Forest, beside, connected_components, group_runs, grouped, tiled
from .shared import materialize, tasks_for
from .textkit import U64, mix

COSINE = 0.9
TABLES, PROBES, SCALE, BLOCKS = 8, 16, 0.5, 2
#: How far below the wanted cosine the integer copies may be.
MARGIN = 0.02
TILE = 1500
#: Products of vector components that are held at once where many small cells are compared.
HELD = 4 << 20


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    f = np.rint(y)
    d = y - f
    k = np.abs(d).argmax(1)
    r = np.arange(len(y))
    f[r, k] += np.where(f.sum(1) % 2 != 0, np.where(d[r, k] >= 0, 1, -1), 0)
    return f


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by one half: the nearer of the two nearest points."""
    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of the lattice, made from their two shapes."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


_ROOTS = np.concatenate([np.zeros((1, 8)), e8_roots()])


def _cell_hash(points: np.ndarray, salt: int) -> np.ndarray:
    twice = np.rint(2 * points).astype(np.int64).astype(U64)
    h = np.full(len(points), salt, U64)
    for i in range(points.shape[1]):
        h = mix(h ^ twice[:, i] * U64(0x9E3779B97F4A7C15))
    return h


def cells(unit: np.ndarray, table: int, probes: int = PROBES, scale: float = SCALE, blocks: int = BLOCKS) -> np.ndarray:
    """(vectors, 1 + probes) cell hashes in a table: the own cell, then neighbours, nearest first."""
    dim = unit.shape[1]
    rng = np.random.default_rng([table, dim, blocks])
    y = unit @ (rng.normal(size=(dim, 8 * blocks)) * scale)
    keep = min(probes + 1, len(_ROOTS))
    cost, hashed = None, None
    for b in range(blocks):
        part = y[:, 8 * b : 8 * b + 8]
        own = nearest_e8(part)
        rest = part - own
        # |rest - root|^2 - |rest|^2
        extra = (_ROOTS**2).sum(1)[None, :] - 2 * rest @ _ROOTS.T
        near = np.argpartition(extra, keep - 1, axis=1)[:, :keep]
        extra = np.take_along_axis(extra, near, 1)
        h = np.stack([_cell_hash(own + _ROOTS[near[:, i]], (table << 8) + b + (dim << 20)) for i in range(keep)], 1)
        if cost is None:
            cost, hashed = extra, h
        else:
            both = (cost[:, :, None] + extra[:, None, :]).reshape(len(unit), -1)
            mixed = mix(hashed[:, :, None] * U64(3) ^ h[:, None, :]).reshape(len(unit), -1)
            best = np.argpartition(both, keep - 1, axis=1)[:, :keep]
            cost, hashed = np.take_along_axis(both, best, 1), np.take_along_axis(mixed, best, 1)
    order = np.argsort(cost, axis=1, kind="stable")
    return np.take_along_axis(hashed, order, 1)


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, double matrix) for each vector length of a list column."""
    off = column.offsets.to_numpy()
    size = np.diff(off)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    out = []
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        out.append((rows, values[(off[:-1][rows][:, None] + np.arange(n)[None, :])]))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)
    x = x / big
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(embedding: str):
    e = F.col(embedding)
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return e.isNotNull() & (F.size(e) > 0) & ~F.coalesce(bad, F.lit(False)) & F.exists(e, lambda x: x != 0)


def _hash_rows(batches):
    """(place, id) of every probe; place is the cell, with its last bit 0 for the vector stored there."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, x in _matrix(batch.column(1)):
            u = _unit(x)
            for t in range(TABLES):
                h = cells(u, t).view(np.int64) | 1
                h[:, 0] -= 1
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel()), pa.array(np.repeat(ids[rows], h.shape[1]))], ["place", "id"])


def _copies(batches):
    """(id, small): vectors as bytes, by which candidates are selected."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, x in _matrix(batch.column(1)):
            small = np.rint(x / np.abs(x).max(1, keepdims=True) * 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array([r.tobytes() for r in small], pa.binary())], ["id", "small"])


def _meeting(most: int):
    """Rows (place, id), sorted by place, to (cell, id, home, over) of cells that hold a stored row and another.

    Stored rows come first in a cell. Column over tells the rows after its first ``most``. One row is held at most.
    """

    def meet(batches):
        held: pa.RecordBatch | None = None  # a stored row that is alone in its cell so far
        last, seen = None, 0  # the last cell and its rows given so far, 0 if none go on
        for batch in batches:
            if held is not None:
                batch, held, last = pa.concat_batches([held, batch]), None, None
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy()
            cell, home = place >> 1, place & 1 == 0
            start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            size = np.diff(np.append(start, len(cell)))
            before = np.zeros(len(start), np.int64)
            good = home[start]
            if last is not None and cell[0] == last:
                before[0], good[0] = seen, seen > 0
            if good[-1] and before[-1] + size[-1] == 1:
                held = batch.slice(len(cell) - 1)
            good &= before + size > 1
            last, seen = cell[-1], int(before[-1] + size[-1]) if good[-1] else 0
            rank = np.arange(len(cell)) - np.repeat(start - before, size)
            rows = pa.RecordBatch.from_arrays([pa.array(cell), batch.column("id"), pa.array(home), pa.array(rank >= most)], ["cell", "id", "home", "over"])
            yield rows.filter(pa.array(np.repeat(good, size)))

    return meet


def _edges(ids: np.ndarray, forest: Forest) -> list[pa.Array]:
    """u and v of a forest over ``ids``."""
    root = forest.roots()
    own = np.flatnonzero(root != np.arange(len(root)))
    return [pa.array(ids[own]), pa.array(ids[root[own]])]


def _matrices(small: pa.Array):
    """(row numbers, unit matrix) for each length of packed copies."""
    off = np.frombuffer(small.buffers()[1], np.int32)[small.offset : small.offset + len(small) + 1]
    data = np.frombuffer(small.buffers()[2], np.int8)
    size = np.diff(off)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        x = data[off[:-1][rows][:, None] + np.arange(n)[None, :]].astype(np.float32)
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _near_in_cells(start: np.ndarray, size: np.ndarray, home: np.ndarray, small: pa.Array, least: float):
    """Rows (a, b) of one cell, a stored in it, whose copies have a cosine of ``least`` or more, in parts."""
    group = np.repeat(np.arange(len(size)), size)
    stored = np.flatnonzero(home & (size[group] > 1))
    kept = np.flatnonzero(np.isin(group, group[stored]))  # the others' copies are not unpacked
    if not len(kept):
        return
    place = np.full(len(home), -1)
    for rows, x in _matrices(small.take(pa.array(kept))):
        place[:] = -1
        place[kept[rows]] = np.arange(len(rows))
        own = stored[place[stored] >= 0]
        many = size[group[own]]
        stop = np.cumsum(many)
        i = 0
        while i < len(own):
            j = max(i + 1, int(np.searchsorted(stop, (stop[i - 1] if i else 0) + HELD // x.shape[1], side="right")))
            n = many[i:j]
            a = np.repeat(own[i:j], n)
            b = np.arange(len(a)) + np.repeat(start[group[own[i:j]]] - (np.cumsum(n) - n), n)
            some = (place[b] >= 0) & (~home[b] | (b > a))  # two stored rows meet once
            a, b = a[some], b[some]
            near = np.einsum("ij,ij->i", x[place[a]], x[place[b]]) >= least
            yield a[near], b[near]
            i = j


def _link_small_cells(least: float):
    """Sorted rows of cells to edges (u, v).

    All cells that end in a batch are compared together; the last one is held until it ends.
    """

    def compared(held: list):
        rows = pa.Table.from_batches(held).combine_chunks()
        if not rows.num_rows:
            return
        rows = rows.to_batches()[0]
        cell = rows.column("cell").to_numpy()
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(start, len(cell)))
        distinct, place = np.unique(rows.column("id").to_numpy(), return_inverse=True)
        forest = Forest(len(distinct))
        for a, b in _near_in_cells(start, size, rows.column("home").to_numpy(zero_copy_only=False), rows.column("small"), least):
            forest.union_pairs(place[a], place[b])
        u, v = _edges(distinct, forest)
        if len(u):
            yield pa.RecordBatch.from_arrays([u, v], ["u", "v"])

    def link(batches):
        held: list = []  # rows of the last cell
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy()
            cut = int(np.searchsorted(cell, cell[-1], side="left"))
            if cut or (held and held[-1].column("cell")[0].as_py() != cell[0]):
                yield from compared([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from compared(held)

    return link


def _link_cells(least: float):
    def link(batches):
        for group in group_runs(batches):
            home = group.column("home").to_numpy()
            if group.num_rows < 2 or not home.any():
                continue
            ids = group.column("id").to_numpy()
            x = np.frombuffer(b"".join(group.column("small").to_pylist()), np.int8).reshape(len(ids), -1).astype(np.float32)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            distinct, place = np.unique(ids, return_inverse=True)
            forest = Forest(len(distinct))
            stored = np.flatnonzero(home)
            for k in range(0, len(ids), 1024):
                a, b = np.nonzero(x[k : k + 1024] @ x[stored].T >= least)
                forest.union_pairs(place[a + k], place[stored[b]])
            u, v = _edges(distinct, forest)
            if len(u):
                yield pa.RecordBatch.from_arrays([u, v], ["u", "v"])

    return link


def _count_links(cosine: float):
    def count(batches):
        for group in group_runs(batches):
            side = group.column("g_side").to_numpy()
            across = group.column("g_i")[0].as_py() != group.column("g_j")[0].as_py()
            ids, many = group.column("id").to_numpy(), group.column("copies").to_numpy()
            vectors = group.column("vector").combine_chunks()
            links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
            for rows, x in _matrix(vectors):
                u = _unit(x)
                left, right = (np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1)) if across else (np.arange(len(rows)),) * 2
                for k in range(0, len(left), 1024):
                    some = left[k : k + 1024]
                    near = u[some] @ u[right].T >= cosine
                    if not across:
                        near[np.arange(len(some)), some] = False
                    links[rows[some]] += near @ many[rows[right]]
                    if across:
                        links[rows[right]] += many[rows[some]] @ near
                    a, b = np.nonzero(near)
                    forest.union_pairs(rows[some[a]], rows[right[b]])
            root = forest.roots()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[root])], ["id", "links", "root"])

    return count


def near_duplicate_vectors(spark: SparkSession, vectors: DataFrame, *, id_col: str = "vec_id", embedding_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(_usable(embedding_col), F.col(embedding_col).cast("array<double>")).alias("vector"))
    # equal vectors are one; its number is the least id, or a hash that no id has
    one = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.count("vec_id").alias("named"))
    one = materialize(spark, one.withColumn("id", F.coalesce("least", F.xxhash64("vector"))), "vectors")
    n = one.count()
    spread = one.select("id", "vector").repartition(tasks_for(spark, n, 4000))
    dealt = spread.mapInArrow(_hash_rows, "place long, id long").repartition(tasks_for(spark, n * TABLES * (PROBES + 1), 1_000_000), F.shiftright("place", 1))
    rows_met = dealt.sortWithinPartitions("place").mapInArrow(_meeting(TILE), "cell long, id long, home boolean, over boolean")
    rows_met = materialize(spark, rows_met, "met")
    large = materialize(spark, rows_met.where("over").select("cell", F.lit(True).alias("large")).distinct(), "large")
    met = beside(rows_met, large, "cell", F.col("id")).join(one.select("id", "vector").mapInArrow(_copies, "id long, small binary"), "id")
    parts = tasks_for(spark, rows_met.count(), 400_000)
    small_cells = met.where("large IS NULL").select("cell", "id", "home", "small").repartition(parts, "cell").sortWithinPartitions("cell")
    edges = materialize(spark, small_cells.mapInArrow(_link_small_cells(cosine - MARGIN), "u long, v long"), "pairs")
    if not large.isEmpty():
        wide = materialize(spark, met.where("large").select("cell", "id", "home", "small"), "wide")
        meeting = grouped(tiled(spark, wide, F.col("cell"), F.col("id"), TILE), tasks_for(spark, 4 * wide.count(), 400_000)).select("g_key", "g_i", "g_j", "id", "home", "small")
        edges = edges.unionByName(meeting.mapInArrow(_link_cells(cosine - MARGIN), "u long, v long"))
    groups = connected_components(spark, edges)
    members = one.join(groups, "id")
    parts = tasks_for(spark, n, 3000)
    exact = grouped(tiled(spark, members.select("id", "vector", "copies", "component"), F.col("component"), F.col("id"), TILE), parts).select("g_key", "g_i", "g_j", "g_side", "id", "copies", "vector")
    exact = materialize(spark, exact.mapInArrow(_count_links(cosine), "id long, links long, root long"), "links")
    part = connected_components(spark, exact.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = exact.groupBy("id").agg(F.sum("links").alias("links"))
    result = one.join(links, "id", "left").join(part, "id", "left")
    # a component's id is the least vec_id in it; numbers of nameless vectors are not ids
    named = result.select("vector", "copies", "links", F.coalesce("component", "id").alias("component"), "least")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component")
    out = rows.join(named.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
