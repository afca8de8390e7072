"""N-gram Jaccard join with signature trees.

Documents become sets of word shingles; equal sets are one vertex. Two sets of
Jaccard similarity t or more share one of the first n - ceil(t n) + 1 shingles
of any common order, so every set is listed under those only. The order puts
shingles that very many documents share last, so that they are hardly ever
listed. Shingles listed once are dropped.

The sets under one shingle form a signature tree: leaves hold bitmaps of the
listed shingles, inner nodes the OR of their children, both with ranges of set
sizes. Two nodes are compared together; the pair is left as soon as the shingles
its bitmaps share, with all that is not listed, cannot reach the overlap that
its sizes ask for. What remains is a graph of possible links, of which only a
spanning forest leaves a task. Its components are compared again by trees over
exact bitmaps of whole sets; links found there are real.

A chance shingle or two under which long sets meet joins many of them to one group of possible links,
since bitmaps of a fixed width say little of them. So the sets of a group that is too large for a task are
compared once more by bitmaps of whole sets as wide as the sets ask for, which parts it before any text is moved.

A class that links already join is not compared further inside. Large groups
are cut to tiles by their shingles: first the members of each tile meet, and one
member of the group; only tiles of groups that still hold several classes meet
each other. Shingles that very many documents share are dealt over several tasks.
No step is approximate: sets are compared by 63-bit hashes of shingles, and equal
texts by a 64-bit sum of those.

Defined cases: null and empty texts have size 0 and link with nothing; a text of
fewer words than a shingle is one shingle; rows of a null id keep their size,
link with nothing and have a null component; repeated rows get equal results;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import Forest, group_runs, known_classes, meet
from .shared import in_slots, materialize, string_buffers, tasks_for
from .textkit import U64, mix, shingles, span_hashes, words

#: Similarity as a fraction of whole numbers, and words of a shingle.
PART, WHOLE, SHINGLE = 80, 100, 5
SIGNATURE_WORDS = 8  # of 64 bits
#: Sets up to this size have a signature of all their shingles; larger ones of the listed and shared ones.
WHOLE_MOST = 600
LEAF, FAN = 16, 4
#: Most rows under one shingle, and texts and shingles of one group, that meet in a task at once.
TILE_ROWS, TILE_TEXTS, TILE_SHINGLES = 2000, 4096, 1 << 20
#: Bits of a wide signature for each shingle at least, and bytes of wide signatures that meet in a task at once.
WIDE_BITS, TILE_WIDE = 2, 16 << 20
#: Bytes of the signatures of one group of texts.
SIGNATURE_BYTES = 8 << 20
#: Listed shingles that a task gathers before it sends them, and of one bucket.
HELD, SPREAD = 2_000_000, 50_000
#: A shingle is frequent if so many documents, or this share of them, hold it; bound of their number.
FREQUENT, FREQUENT_SHARE, FREQUENT_MOST = 64, 1000, 1 << 18
SLICE_BYTES = 4 << 20
_TOP = U64(1 << 63)


def least_overlap(a, b, part: int = PART, whole: int = WHOLE):
    """Smallest overlap at which sets of sizes a and b are similar."""
    # whole * i >= part * (a + b - i)
    return -(-(part * (a + b)) // (whole + part))


def listed(n, part: int = PART, whole: int = WHOLE):
    """How many of its first shingles a set of size n is listed under."""
    return np.where(n > 0, n - -(-(part * n) // whole) + 1, 0)


def inner(n):
    """How many of the listed shingles of a set the one called ``near`` closes: three quarters of them."""
    return (3 * listed(n)) // 4


def text_sets(column, frequent: np.ndarray, k: int = SHINGLE):
    """(values, offsets): the ascending distinct shingle codes of each text.

    The top bit of a code marks the frequent ones, so they come last.
    """
    raw, off = string_buffers(column)
    values, sizes, i = [], [], 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        st, en, docs, data = words(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        h, d = shingles(span_hashes(data, st, en), docs, j - i, k)
        h >>= U64(1)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
            h = np.where(frequent[at] == h, h | _TOP, h)
        edge = np.searchsorted(d, np.arange(j - i + 1))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            h[a:b].sort()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        values.append(h[new])
        sizes.append(np.bincount(d[new], minlength=j - i))
        i = j
    flat = np.concatenate(values) if values else np.zeros(0, U64)
    return flat, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64) if sizes else np.zeros(1, np.int64)


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """An order-free 64-bit number of each set (0 for the empty set)."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix((values & ~_TOP) + U64(0x51ED2701)))])
    n = np.diff(off)
    return np.where(n > 0, mix((total[off[1:]] - total[off[:-1]]) ^ (n.astype(U64) << U64(40))), U64(0)).view(np.int64)


def _bits(n: int, owner: np.ndarray, bit: np.ndarray, width: int) -> np.ndarray:
    """(n, width) words of 64 bits with the given bits set."""
    out = np.zeros(n * width * 64, np.uint8)
    out[owner * (width * 64) + bit] = 1
    return np.packbits(out.reshape(n, width * 64), axis=1, bitorder="little").view(U64)


def _signatures(n: int, owner: np.ndarray, codes: np.ndarray, width: int = SIGNATURE_WORDS) -> np.ndarray:
    """Signatures of n sets, given by the codes of each; the mark of frequent codes does not count."""
    return _bits(n, owner, (mix((codes & ~_TOP) + U64(99)) % U64(64 * width)).astype(np.int64), width)


class Tree:
    """A signature tree over rows sorted by set size.

    Of each node: OR bitmap, least and largest set size, most listed shingles
    beyond distinct bits (``excess``), most shingles that are not in the bitmap
    (``rest``), first and last of the last listed shingles (``last``), the latest of those that
    close three quarters of a list (``near``) and most shingles past it, most shingles
    that are listed by others too (``shared``), and whether bitmaps are of whole sets. Of two sets,
    the one whose list ends first can have no more in common with the other than
    what both list and its own rest: all that it does not list comes after its list. Levels are arrays; node i of a level has children FAN*i ... of
    the one below, and leaf i holds rows LEAF*i ...
    """

    def __init__(self, bits: np.ndarray, size: np.ndarray, excess: np.ndarray, rest: np.ndarray, last: np.ndarray, near: np.ndarray, shared: np.ndarray, whole: np.ndarray):
        outer = size - np.where(inner(size) > 0, inner(size), 0)
        level, width = (bits, size, size, excess, rest, last, last, near, outer, shared, whole, whole), LEAF
        self.rows, self.size, self.bits = level, size, bits
        folds = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.maximum, np.minimum, np.maximum, np.maximum, np.maximum, np.maximum, np.minimum, np.maximum)
        self.levels = []
        while not self.levels or len(level[0]) > 1:
            at = np.arange(0, len(level[0]), width)
            level = tuple(f.reduceat(x, at) for f, x in zip(folds, level, strict=True))
            self.levels.append(level)
            width = FAN

    @staticmethod
    def _may_link(nodes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bits, low, high, excess, rest, early, late, near, outer, shared, all_whole, some_whole = nodes
        common = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64) + np.minimum(excess[a], excess[b])
        # what can be common past the list that ends first: its own rest, and of the other what lies past its near code
        if_a = np.minimum(rest[a], np.where(early[a] > near[b], outer[b], high[b]))
        if_b = np.minimum(rest[b], np.where(early[b] > near[a], outer[a], high[a]))
        beyond = np.where(late[a] < early[b], if_a, np.where(late[b] < early[a], if_b, np.maximum(if_a, if_b)))
        most = np.minimum(shared[a], shared[b]) + beyond
        most = np.where(all_whole[a] & all_whole[b], np.minimum(most, common), most)
        most = np.where(some_whole[a] | some_whole[b], most, np.minimum(most, common + beyond))
        return np.minimum(most, np.minimum(high[a], high[b])) >= least_overlap(low[a], low[b])

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which node pairs can hold a link: the maximum possible overlap against the least one asked for."""
        return self._by_parts(self.levels[level], a, b)

    def rows_may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._by_parts(self.rows, a, b)

    def _by_parts(self, nodes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        step = max(1, (1 << 21) // self.bits.shape[1])
        return np.concatenate([np.zeros(0, bool), *(self._may_link(nodes, a[k : k + step], b[k : k + step]) for k in range(0, len(a), step))])

    def leaf_pairs(self, forest: Forest):
        """Pairs of leaves that may link, by dual traversal from the root, level by level.

        Pairs of one class (of ``forest``) are left out as the traversal meets
        them. Each pair is given once, with a <= b.
        """
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self.may_link(level, a, b)
            a, b = a[keep], b[keep]
            if level == 0:
                break
            below = len(self.levels[level - 1][0])
            i, j = (x.ravel() for x in np.meshgrid(np.arange(FAN), np.arange(FAN), indexing="ij"))
            a, b = (FAN * a[:, None] + i).ravel(), (FAN * b[:, None] + j).ravel()
            keep = (a <= b) & (b < below)
            a, b = a[keep], b[keep]
        order = np.argsort(b - a, kind="stable")  # neighbours first: they join classes early
        for k in range(0, len(a), 256):
            some = order[k : k + 256]
            yield a[some], b[some]

    def join(self, forest: Forest, linked) -> None:
        """Unite rows that ``linked(rows a, rows b)`` tells to be linked, among all that may be."""
        i, j = (x.ravel() for x in np.meshgrid(np.arange(LEAF), np.arange(LEAF), indexing="ij"))
        for a, b in self.leaf_pairs(forest):
            x, y = (LEAF * a[:, None] + i).ravel(), (LEAF * b[:, None] + j).ravel()
            ok = (x < y) & (y < len(self.size))
            x, y = x[ok], y[ok]
            root = forest.roots()
            ok = root[x] != root[y]
            x, y = x[ok], y[ok]
            hit = linked(x, y)
            forest.union_pairs(x[hit], y[hit])


# --- 1: sets of the texts, listed under their first shingles -------------------


def _frequent(batches):
    """Shingles in many documents of a batch, with how many."""
    for batch in batches:
        values, _ = text_sets(batch.column(0), np.zeros(0, U64))
        v, n = np.unique(values, return_counts=True)
        many = n >= max(4, batch.num_rows // 200)
        yield pa.RecordBatch.from_arrays([pa.array(v[many].view(np.int64)), pa.array(n[many])], ["code", "n"])


def _sizes(frequent_of):
    """Of each document: size, vertex, whole signature, and high halves of the last listed code and of that at three quarters."""

    def run(batches):
        frequent = frequent_of.value[0]
        for batch in batches:
            yield _size_batch(batch, *text_sets(batch.column(1), frequent))

    return run


def _size_batch(batch, values, off):
    n = np.diff(off)
    small = (n > 0) & (n <= WHOLE_MOST)
    row = np.cumsum(small) - 1
    owner = np.repeat(np.arange(len(n)), n)
    keep = small[owner]
    bits = _signatures(int(small.sum()), row[owner[keep]], values[keep])
    signature = pa.array([bits[row[i]].tobytes() if small[i] else None for i in range(len(n))], pa.binary())
    full = np.flatnonzero(n)
    ends = np.zeros((2, len(n)), U64)
    ends[0, full] = values[off[:-1][full] + listed(n[full]) - 1] >> U64(32)
    ends[1, full] = values[off[:-1][full] + np.maximum(inner(n[full]), 1) - 1] >> U64(32)
    last = (ends[0] << U64(32) | ends[1]).view(np.int64)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(_sums(values, off)), pa.array(last), signature], ["doc_id", "n", "vertex", "last", "whole"])


def _lister(frequent_of, buckets: int):
    """Listed codes by bucket. A frequent one is dealt over several buckets by its vertices."""

    def blobs(held):
        code, vertex = (np.concatenate(x) for x in zip(*held, strict=True))
        frequent, count = frequent_of.value
        spread = np.zeros(len(code), U64)
        often = np.flatnonzero(code >= _TOP)
        if len(often):
            parts = -(-count[np.searchsorted(frequent, code[often] & ~_TOP)] // SPREAD)
            spread[often] = mix(vertex[often].view(U64)) % parts.astype(U64)
        bucket = (mix(code + spread * U64(0x9E3779B97F4A7C15)) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edge))
        for k in range(0, len(full), 256):
            some = full[k : k + 256]
            blob = lambda x: pa.array([x[order[edge[b] : edge[b + 1]]].tobytes() for b in some], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blob(code), blob(vertex)], ["bucket", "codes", "vertices"])

    def make(batches):
        frequent = frequent_of.value[0]
        held, many = [], 0
        for batch in batches:
            values, off = text_sets(batch.column(0), frequent)
            n, key = np.diff(off), _sums(values, off)
            _, first = np.unique(key, return_index=True)  # copies within the batch are listed once
            first = first[n[first] > 0]
            count = listed(n[first])
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(off[:-1][first], count)
            held.append((values[at], key[np.repeat(first, count)]))
            many += len(at)
            if many >= HELD:
                yield from blobs(held)
                held, many = [], 0
        if held:
            yield from blobs(held)

    return make


def _shared_codes(frequent_of, buckets: int):
    """Of a bucket: the codes that two vertices or more are listed under, in parts by vertex.

    Codes of the same holders get the same key, so that the holders need to meet
    only once; of a code that is dealt over several buckets the key is the code.
    Each entry has the number of tiles that the rows of its key are cut to.
    """

    def run(batches):
        frequent, count = frequent_of.value
        parts = [(np.frombuffer(x, U64), np.frombuffer(y, np.int64)) for batch in batches for x, y in zip(batch.column("codes").to_pylist(), batch.column("vertices").to_pylist(), strict=True)]
        if not parts:
            return
        c, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((v, c))
        c, v = c[order], v[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (v[1:] != v[:-1])
        c, v = c[new], v[new]
        edge = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(c))))
        rows = np.bincount(group)[group]
        key = mix(np.add.reduceat(mix(v.view(U64)), edge))[group]
        often = np.flatnonzero(c >= _TOP)
        if len(often):  # what is dealt out has more rows in other buckets
            of = count[np.searchsorted(frequent, c[often] & ~_TOP)]
            dealt, of = often[of > SPREAD], of[of > SPREAD]
            rows[dealt] = np.maximum(rows[dealt], of)
            key[dealt] = c[dealt]
        shared = rows > 1
        c, v, key, tiles = c[shared], v[shared], key[shared], (-(-rows[shared] // TILE_ROWS)).astype(np.int32)
        to = (mix(v.view(U64) ^ U64(0x7E57)) % U64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        edge = np.searchsorted(to[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edge))
        for k in range(0, len(full), 256):
            some = full[k : k + 256]
            blob = lambda x: pa.array([x[order[edge[b] : edge[b + 1]]].tobytes() for b in some], pa.binary())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blob(v), blob(c), blob(key), blob(tiles)], ["bucket", "vertices", "codes", "keys", "tiles"])

    return run


def _by_vertex(batches):
    """Rows of vertices: shared codes, distinct keys with their tiles, and whether any key has several tiles."""
    kinds = (("vertices", np.int64), ("codes", U64), ("keys", U64), ("tiles", np.int32))
    parts: list = []
    for batch in batches:
        parts += [[np.frombuffer(x, t) for x, (_, t) in zip(row, kinds, strict=True)] for row in zip(*(batch.column(c).to_pylist() for c, _ in kinds), strict=True)]
    if not parts:
        return
    v, c, key, tiles = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    order = np.lexsort((key, v))
    v, c, key, tiles = v[order], c[order], key[order], tiles[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (key[1:] != key[:-1])
    edge = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    ends = np.append(edge[1:], len(v))
    large = np.maximum.reduceat(tiles, edge) > 1
    k1 = np.concatenate([[0], np.cumsum(new)])
    key, tiles = key[new], tiles[new]
    for k in range(0, len(edge), 20_000):
        a, b = edge[k : k + 20_000], ends[k : k + 20_000]
        blob = lambda x, i, j: pa.array([x[p:q].tobytes() for p, q in zip(i, j, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v[a]), blob(c, a, b), blob(key, k1[a], k1[b]), blob(tiles, k1[a], k1[b]), pa.array(large[k : k + 20_000])], ["vertex", "codes", "keys", "tiles", "large"])


# --- 2: possible links under each shingle ---------------------------------------


def _sign(batches):
    """One row for each key of a vertex, with the signature of its set, or of all its shared codes if it is large."""
    for batch in batches:
        n, last = batch.column("n").to_numpy(), batch.column("last").to_numpy()
        v = batch.column("vertex").to_numpy()
        read = lambda name, t: [np.frombuffer(x, t) for x in batch.column(name).to_pylist()]  # noqa: B023, E731
        codes, keys, tiles = read("codes", U64), read("keys", np.int64), read("tiles", np.int32)
        if not codes:
            continue
        count = np.array([len(x) for x in codes])
        owner = np.repeat(np.arange(len(codes)), count)
        whole = batch.column("whole").to_pylist()
        rows = [w or r.tobytes() for w, r in zip(whole, _signatures(len(codes), owner, np.concatenate(codes)), strict=True)]
        flat, cut = np.concatenate(keys), np.concatenate(tiles)
        owner = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        for k in range(0, len(flat), 50_000):
            o = owner[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(flat[k : k + 50_000]), pa.array(cut[k : k + 50_000]), pa.array(v[o]), pa.array(n[o].astype(np.int32)), pa.array(last[o]), pa.array(count[o].astype(np.int32)), pa.array([rows[i] for i in o], pa.binary())], ["g_key", "g_tiles", "g_id", "n", "last", "shared", "signature"])


def _possible(batches):
    """A spanning forest of the possible links of the groups that come by.

    Groups of at most a leaf are compared together, row by row at distances 1,
    2, ...; larger ones by their trees.
    """
    for table in _whole_groups(batches):
        v = table.column("g_id").to_numpy()
        n, last, shared = (table.column(x).to_numpy().astype(np.int64) for x in ("n", "last", "shared"))
        bits = np.frombuffer(b"".join(table.column("signature").to_pylist()), U64).reshape(len(v), -1)
        key = [table.column(k).to_numpy() for k in ("g_key", "g_i", "g_j")]
        edge = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0)))
        size = np.diff(np.append(edge, len(v)))
        last, near = (last.view(U64) >> U64(32)).astype(np.int64), last & 0xFFFFFFFF
        whole = n <= WHOLE_MOST
        excess = np.where(whole, n, shared) - np.bitwise_count(bits).sum(1, dtype=np.int64)
        rest = n - listed(n)
        distinct, place = np.unique(v, return_inverse=True)
        forest = Forest(len(distinct))
        told = table.column("g_class").combine_chunks()
        known_classes(place, told.fill_null(0).to_numpy(zero_copy_only=False), told.is_valid().to_numpy(zero_copy_only=False), forest)
        group = np.repeat(np.arange(len(edge)), size)
        small = size[group] <= LEAF
        flat = Tree(bits, n, excess, rest, last, near, shared, whole) if small.any() else None
        for d in range(1, LEAF):
            a = np.flatnonzero(small[:-d] & (group[d:] == group[:-d])) if d < len(v) else np.zeros(0, np.int64)
            if not len(a):
                break
            root = forest.roots()
            a = a[root[place[a]] != root[place[a + d]]]
            hit = flat.rows_may_link(a, a + d)
            forest.union_pairs(place[a[hit]], place[a[hit] + d])
        for g in np.flatnonzero(size > LEAF):
            rows = np.arange(edge[g], edge[g] + size[g])
            rows = rows[np.lexsort((v[rows], n[rows]))]
            known = forest.roots()[place[rows]]
            if (known == known[0]).all():
                continue
            own = Forest(len(rows))
            known_classes(np.arange(len(rows)), known, np.ones(len(rows), bool), own)
            tree = Tree(bits[rows], n[rows], excess[rows], rest[rows], last[rows], near[rows], shared[rows], whole[rows])
            tree.join(own, tree.rows_may_link)
            forest.union_pairs(place[rows], place[rows[own.roots()]])
        root = forest.roots()
        own = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(distinct[own]), pa.array(distinct[root[own]])], ["u", "v"])


def _whole_groups(batches, rows: int = 100_000):
    """Tables of whole groups, of about ``rows`` rows or one larger group."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        t = pa.Table.from_batches(held)
        key = [t.column(k).to_numpy() for k in ("g_key", "g_i", "g_j")]
        last = np.all([k == k[-1] for k in key], axis=0)
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield t.slice(0, cut)
            rest = t.slice(cut).combine_chunks()
            held, count = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


# --- 3: real links within groups of possible ones ---------------------------------


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two ascending arrays have in common."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def exact_links(values: list[np.ndarray], forest: Forest | None = None) -> np.ndarray:
    """For sets given as ascending arrays: the root of each one's class under real links.

    ``forest`` has the classes known before. A signature tree of bounded size leaves
    the pairs that may link; those of different classes are compared exactly, one by
    one, and what links at once takes all other pairs of its two classes away.
    """
    forest = forest or Forest(len(values))
    size = np.array([len(x) for x in values])
    if len(values) < 2 or (forest.roots() == forest.roots()[0]).all():
        return forest.roots()
    order = np.argsort(size, kind="stable")
    n = size[order]
    most = max(1, SIGNATURE_BYTES // (8 * len(values)))
    width = int(np.clip(1 << int(n[-1] // 16).bit_length(), SIGNATURE_WORDS, max(SIGNATURE_WORDS, 1 << (most.bit_length() - 1))))
    rows = max(1, (1 << 25) // (64 * width))  # bounds the unpacked bits
    bits = np.concatenate([_signatures(len(some), np.repeat(np.arange(len(some)), size[some]), np.concatenate([values[i] for i in some]), width) for k in range(0, len(order), rows) for some in [order[k : k + rows]]])
    zero = np.zeros(len(n), np.int64)
    tree = Tree(bits, n, n - np.bitwise_count(bits).sum(1, dtype=np.int64), zero, zero, zero, n, zero == 0)
    own = Forest(len(n))
    known_classes(np.arange(len(n)), forest.roots()[order], np.ones(len(n), bool), own)
    up = own.roots().tolist()

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(a), bool)
        for k in np.flatnonzero(tree.rows_may_link(a, b)).tolist():
            i, j = int(a[k]), int(b[k])
            x, y = root(i), root(j)
            if x != y and _overlap(values[order[i]], values[order[j]]) >= least_overlap(int(n[i]), int(n[j])):
                up[max(x, y)] = min(x, y)
                hit[k] = True
        return hit

    tree.join(own, linked)
    out = np.empty(len(values), np.int64)
    out[order] = order[own.roots()]
    return out


def wide(n):
    """Words of 64 bits of the wide signature of a set of size n, a power of two; sets that may link differ by one step at most."""
    return 1 << np.ceil(np.log2(np.maximum(WIDE_BITS * np.asarray(n), 64) / 64)).astype(np.int64)


def _wide_signatures(batches):
    """Texts of large groups as wide signatures of their whole sets."""
    for batch in batches:
        values, off = text_sets(batch.column("text"), np.zeros(0, U64))
        n, v = np.diff(off), batch.column("g_id").to_numpy()
        own = np.flatnonzero((_sums(values, off) == v) & (n > 0))  # a doc_id may have rows of other texts
        width = wide(n)
        for w in np.unique(width[own]).tolist():
            rows, step = own[width[own] == w], max(1, (1 << 24) // (64 * w))  # bounds the unpacked bits
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                bits = _signatures(len(some), np.repeat(np.arange(len(some)), n[some]), np.concatenate([values[off[i] : off[i + 1]] for i in some]), w)
                yield pa.RecordBatch.from_arrays([batch.column("g_key").take(pa.array(some)), batch.column("g_tiles").take(pa.array(some)), pa.array(v[some]), pa.array(n[some].astype(np.int32)), pa.array([b.tobytes() for b in bits], pa.binary())], ["g_key", "g_tiles", "g_id", "n", "signature"])


def wide_classes(n: np.ndarray, signatures: list[bytes], forest: Forest) -> np.ndarray:
    """Roots of the classes of sets (of sizes n) that may link by their wide signatures.

    Sets of each width meet, together with those of the next width that are not too large for
    them, whose signatures are folded to the narrower ones.
    """
    width = np.array([len(x) // 8 for x in signatures])
    for w in np.unique(width).tolist():
        most = n[width == w].max()
        rows = np.flatnonzero((width == w) | ((width == 2 * w) & (PART * n <= WHOLE * most)))
        if len(rows) < 2 or (forest.roots()[rows] == forest.roots()[rows[0]]).all():
            continue
        rows = rows[np.argsort(n[rows], kind="stable")]
        bits = np.stack([np.bitwise_or.reduce(np.frombuffer(signatures[i], U64).reshape(-1, w), axis=0) for i in rows.tolist()])
        size, zero = n[rows], np.zeros(len(rows), np.int64)
        tree = Tree(bits, size, size - np.bitwise_count(bits).sum(1, dtype=np.int64), zero, zero, zero, size, zero == 0)
        own = Forest(len(rows))
        known_classes(np.arange(len(rows)), forest.roots()[rows], np.ones(len(rows), bool), own)
        tree.join(own, tree.rows_may_link)
        forest.union_pairs(rows, rows[own.roots()])
    return forest.roots()


def _possible_wide(batches):
    """Pairs that make a spanning forest of the links that are possible by wide signatures."""
    for table in group_runs(batches):
        vertex = table.column("g_id").to_numpy()
        first = np.unique(vertex, return_index=True)[1]
        told = table.column("g_class").combine_chunks().take(pa.array(first))
        forest = Forest(len(first))
        known_classes(np.arange(len(first)), told.fill_null(0).to_numpy(zero_copy_only=False), told.is_valid().to_numpy(zero_copy_only=False), forest)
        root = wide_classes(table.column("n").to_numpy().astype(np.int64)[first], table.column("signature").take(pa.array(first)).to_pylist(), forest)
        own = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(vertex[first][own]), pa.array(vertex[first][root[own]])], ["u", "v"])


def _real(batches):
    for table in group_runs(batches):
        values, off = text_sets(table.column("text"), np.zeros(0, U64))
        vertex = table.column("g_id").to_numpy()
        own = np.flatnonzero(_sums(values, off) == vertex) if len(vertex) else np.zeros(0, np.int64)  # a doc_id may have rows of other texts
        first = own[np.unique(vertex[own], return_index=True)[1]]
        told = table.column("g_class").combine_chunks().take(pa.array(first))
        forest = Forest(len(first))
        known_classes(np.arange(len(first)), told.fill_null(0).to_numpy(zero_copy_only=False), told.is_valid().to_numpy(zero_copy_only=False), forest)
        root = exact_links([values[off[i] : off[i + 1]] for i in first], forest)
        own = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(vertex[first][own]), pa.array(vertex[first][root[own]])], ["u", "v"])


def jaccard_components(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = rows.select("doc_id").count()
    often = rows.select("text").mapInArrow(_frequent, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    often = often.where(F.col("n") >= max(FREQUENT, n // FREQUENT_SHARE)).orderBy(F.desc("n"), "code").limit(FREQUENT_MOST).toArrow()
    code, many = often.column("code").to_numpy().view(U64), often.column("n").to_numpy()
    frequent = spark.sparkContext.broadcast((np.sort(code), many[np.argsort(code)]))
    buckets = tasks_for(spark, n, 10_000)
    members = materialize(spark, rows.mapInArrow(_sizes(frequent), "doc_id long, n long, vertex long, last long, whole binary"), "sizes")
    # texts are read again here: that costs less than to write all lists and read them back
    lists = rows.where("doc_id IS NOT NULL").select("text").mapInArrow(_lister(frequent, buckets), "bucket int, codes binary, vertices binary")
    lists = lists.repartitionById(buckets, "bucket").mapInArrow(_shared_codes(frequent, buckets), "bucket int, vertices binary, codes binary, keys binary, tiles binary")
    lists = materialize(spark, lists, "listed")  # the shuffle files of all lists, the largest there are, go before those of the shared ones are written
    shared = lists.repartitionById(buckets, "bucket").mapInArrow(_by_vertex, "vertex long, codes binary, keys binary, tiles binary, large boolean")
    one = members.where("doc_id IS NOT NULL AND n > 0").groupBy("vertex").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", "last", "whole")))
    one = materialize(spark, one, "vertices")
    shared = materialize(spark, shared.join(one.select("vertex", "n", "last", "whole"), "vertex"), "shared")
    signed = lambda df: df.select("vertex", "n", "last", "whole", "codes", "keys", "tiles").mapInArrow(_sign, "g_key long, g_tiles int, g_id long, n int, last long, shared int, signature binary")
    large = shared.where("large")
    large = None if large.isEmpty() else signed(large).where("g_tiles > 1")
    groups = meet(spark, signed(shared), large, _possible, tasks_for(spark, n, 2500), "n", "g_id")
    # candidates are cut to tiles by their shingles, so that texts of any length fit
    wanted = one.select("vertex", "doc_id", "n").join(groups.withColumnRenamed("id", "vertex"), "vertex")
    size = F.greatest(F.ceil(F.sum("n") / TILE_SHINGLES), F.ceil(F.count(F.lit(1)) / TILE_TEXTS)).cast("int")
    cut = lambda df: materialize(spark, df.groupBy("component").agg(size.alias("g_tiles"), F.sum("n").alias("g_n"), F.count(F.lit(1)).alias("g_rows")), "tiles")
    texts = lambda df: rows.where(in_slots(spark, df.select("doc_id"), F.col("doc_id"))).join(df, "doc_id").drop("doc_id")
    wanted = materialize(spark, wanted, "wanted")
    tiles = cut(wanted)
    if not (many := tiles.where("g_tiles > 1")).isEmpty():
        # a power of two is less than twice what is asked for
        parts = F.greatest(F.ceil(F.col("g_n") * (2 * WIDE_BITS / 8 / TILE_WIDE)), F.ceil(F.col("g_rows") / TILE_TEXTS)).cast("int")
        wide_of = wanted.join(many.select("component", parts.alias("g_tiles")), "component").select(F.col("component").alias("g_key"), "g_tiles", F.col("vertex").alias("g_id"), "doc_id")
        wide_of = materialize(spark, texts(wide_of).mapInArrow(_wide_signatures, "g_key long, g_tiles int, g_id long, n int, signature binary"), "wide")
        large = wide_of.where("g_tiles > 1")
        finer = meet(spark, wide_of, None if large.isEmpty() else large, _possible_wide, tasks_for(spark, n, 2500), "n", "g_id")
        of_finer = wanted.drop("component").join(finer.withColumnRenamed("id", "vertex"), "vertex")
        wanted = wanted.join(many.select("component"), "component", "left_anti").unionByName(of_finer)
        wanted = materialize(spark, wanted, "wanted")
        tiles = cut(wanted)
    wanted = materialize(spark, wanted.join(tiles, "component").select(F.col("component").alias("g_key"), "g_tiles", F.col("vertex").alias("g_id"), "doc_id"), "tiled")
    large = wanted.where("g_tiles > 1")
    large = None if large.isEmpty() else texts(large)
    classes = meet(spark, texts(wanted), large, _real, tasks_for(spark, n, 2500))
    labelled = one.select("vertex", "doc_id").join(classes.withColumnRenamed("id", "vertex"), "vertex", "left").select("vertex", "doc_id", F.coalesce("component", "vertex").alias("component"))
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_vertex = labelled.join(least, "component").select("vertex", "component_id")
    out = members.select("doc_id", "n", "vertex").join(of_vertex, "vertex", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the least id, once.

    Rows of a null id belong to no group and stay. Where one id has rows of
    different texts, it stays if any of them is first of its group, with the row of
    the greatest hash of all its columns. Only rows that may have to go
    (by a table of hash slots) are joined with the ids that stay; all others
    pass where they are.
    """
    found = materialize(spark, jaccard_components(spark, docs, id_col=id_col, text_col=text_col).where("doc_id IS NOT NULL"), "groups")
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id"))
    doubtful = again.where("n > 1 OR doc_id <> component_id")
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].cast("long").alias("id"))
    row = row.withColumn("may_go", F.coalesce(in_slots(spark, doubtful.select("doc_id"), F.col("id")), F.lit(False)) & F.col("id").isNotNull())
    stays = again.where("doc_id = component_id").select(F.col("doc_id").alias("id"))
    one = row.where("may_go").join(stays, "id", "left_semi").groupBy("id").agg(F.max_by("row", F.xxhash64("row")).alias("row"))
    return row.where("NOT may_go").select("row").unionByName(one.select("row")).select("row.*")
