import random

import numpy as np
import pyarrow as pa

from docengine.llm import textkit as T
from docengine.llm.shared import string_buffers


def test_hashes_tell_words_apart():
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 40, 300]))) for _ in range(60)), None, "", "x" * 700 + " x"]
    raw, off = string_buffers(pa.array(texts))
    st, en, docs, data = T.words(raw, off)
    seen: dict[bytes, int] = {}
    for s, e, h in zip(st, en, T.span_hashes(data, st, en), strict=True):
        assert seen.setdefault(bytes(data[s:e]), int(h)) == int(h)
    assert len(set(seen.values())) == len(seen)
    assert [bytes(data[s:e]) for s, e in zip(st, en, strict=True)] == [w for t in texts for w in (t or "").encode().lower().split()]


def test_words_end_with_their_document():
    raw, off = string_buffers(pa.array(["a b", "c", "", "d e"]))
    st, en, docs, _ = T.words(raw, off)
    assert docs.tolist() == [0, 0, 1, 3, 3] and (en - st).tolist() == [1] * 5


def test_slices_of_columns_and_shingles():
    col = pa.chunked_array([["zero", "one two three four five six"], ["A b", None]]).slice(1)
    raw, off = string_buffers(col)
    assert bytes(raw[off[0] : off[1]]) == b"one two three four five six" and len(off) == 4
    st, en, docs, data = T.words(raw, off)
    h, d = T.shingles(T.span_hashes(data, st, en), docs, 3)
    assert np.bincount(d, minlength=3).tolist() == [2, 1, 0]


def test_equal_spans_of_all_lengths():
    rng = np.random.default_rng(5)
    a = rng.integers(97, 99, 4000).astype(np.uint8)
    b = np.concatenate([a[50:], a[:50]])
    at_b = rng.integers(0, 3000, 500)
    size = np.concatenate([rng.integers(0, 30, 400), rng.integers(100, 300, 100)])
    at_a = np.where(rng.random(500) < 0.5, at_b + 50, rng.integers(0, 3000, 500))
    want = [bytes(a[i : i + n]) == bytes(b[j : j + n]) for i, j, n in zip(at_a, at_b, size, strict=True)]
    assert T.equal_spans(a, at_a, b, at_b, size).tolist() == want and 0 < sum(want) < 500
