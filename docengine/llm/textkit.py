"""Vectorised word work on UTF-8 columns.

A whole Arrow batch is handled as one byte array; words, hashes and shingles
come out as flat arrays with the number of the document of each. No step loops
over words in Python.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element by element."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Chunks of a slice that are mixed side by side with those of all others; masks of a chunk's bytes.
_SHORT = 16
_PLACE = mix(np.arange(_SHORT).astype(U64) * U64(_STEP))
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII white space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def as_bytes(raw) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the runs of True, cut at documents."""
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z, z
    prev = np.empty_like(inside)
    prev[0], prev[1:] = False, inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(inside)]
    prev[first] = False
    starts = np.flatnonzero(inside & ~prev)
    nxt = np.empty_like(inside)
    nxt[-1], nxt[:-1] = False, inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    nxt[last] = False
    ends = np.flatnonzero(inside & ~nxt) + 1
    docs = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, docs


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of ``values`` (bytes, or 64-bit items).

    A slice is read in chunks of eight bytes (or one item), counted from its own
    start. Every chunk is mixed with its number in the slice, and the mixed
    chunks are added up: unlike a polynomial in the items this has no structure
    that repeating texts could meet, and equal slices have equal hashes wherever they are.
    """
    out = np.zeros(len(starts), U64)
    if not len(starts):
        return out
    size = ends - starts
    step = 8 if values.dtype == np.uint8 else 1
    many = -(-size // step)
    if step == 8:
        room = np.zeros(len(values) + 8, np.uint8)
        room[: len(values)] = values
        heads = np.ndarray(len(values) + 1, U64, room, 0, (1,))  # the eight bytes from each place on
    else:
        heads = values
    for k in range(int(min(many.max(), _SHORT))):
        long = np.flatnonzero(many > k) if k else slice(None)
        at = starts[long] + step * k
        v = heads[at]
        if step == 8:
            v = v & _KEEP[np.minimum(ends[long] - at, 8)]
        out[long] += mix(v ^ _PLACE[k])
    for i in np.flatnonzero(many > _SHORT):
        at = np.arange(starts[i] + step * _SHORT, ends[i], step)
        v = heads[at]
        if step == 8:
            v = v & _KEEP[np.minimum(ends[i] - at, 8)]
        out[i : i + 1] += mix(v ^ mix(np.arange(_SHORT, many[i]).astype(U64) * U64(_STEP))).sum(dtype=U64)
    return mix(out ^ (size.astype(U64) * U64(0xA24BAED4963EE407)))


def equal_spans(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the slices of bytes at ``at_a`` in ``a`` and at ``at_b`` in ``b``, both of ``size``, are equal; eight bytes at a time."""
    out = np.ones(len(size), bool)
    if not len(size):
        return out
    x, y = (np.ndarray(len(v) + 1, U64, np.append(v, np.zeros(8, np.uint8)), 0, (1,)) for v in (a, b))
    for k in range(int(min(-(-size.max() // 8), _SHORT))):
        long = np.flatnonzero(size > 8 * k) if k else slice(None)
        out[long] &= (x[at_a[long] + 8 * k] ^ y[at_b[long] + 8 * k]) & _KEEP[np.minimum(size[long] - 8 * k, 8)] == 0
    for i in np.flatnonzero(size > 8 * _SHORT):
        out[i] = np.array_equal(a[at_a[i] : at_a[i] + size[i]], b[at_b[i] : at_b[i] + size[i]])
    return out


def words(raw, offsets: np.ndarray, space: np.ndarray = SPACE, lower: bool = True):
    """(starts, ends, docs, lowered bytes) of the words of a batch."""
    data = as_bytes(raw)
    data = LOWER[data] if lower else data
    return (*spans(~space[data], offsets), data)


def shingles(hashes: np.ndarray, docs: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-word shingles and their documents, in text order.

    A document of fewer words gives its whole sequence as one shingle.
    """
    count = np.bincount(docs, minlength=n_docs).astype(np.int64)
    size = np.where(count == 0, 0, np.maximum(count - k + 1, 1))
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n_docs else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n_docs), size)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + first[doc]
    length = np.minimum(count, k)[doc]
    out = np.zeros(len(doc), U64)
    for i in range(k):
        has = i < length
        out[has] = (out[has] + hashes[at[has] + i]) * U64(_STEP)
    return mix(out ^ length.astype(U64)), doc


def sorted_sets(values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document, ascending within it."""
    if not len(values):
        return values, docs
    order = np.lexsort((values, docs))
    v, d = values[order], docs[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return v[new], d[new]
