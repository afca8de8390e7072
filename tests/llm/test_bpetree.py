import base64
import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from docengine.llm import bpetree as B  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SIGNS = ["a", "b", " ", "é", "东", "the", "ing", "\n", "'s", "'l", "1", "=", "  ", "а", "がく", "\t", "😀", "\x1f", "　", "ſ", "\r\n"]


def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIB = library()
CODER = B.Coder(PATH, P.PATTERN, leaf=3)


def ids(x):
    return np.frombuffer(x, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(SIGNS)).map("".join)), st.integers(1, 9))
def test_any_cut_gives_what_the_library_gives(text, k):
    want = LIB.encode_ordinary(text)
    assert ids(CODER.text(text)) == want
    assert ids(CODER.reduce([CODER.element(text[i : i + k]) for i in range(0, len(text), k)] or [CODER.element("")])) == want
    assert CODER.decode(CODER.text(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 3000, "東京都" * 2000, " " * 4000, "x=" * 900 + "é" * 900, "".join(random.Random(3).choices("abcdefgh", k=9000))])
def test_long_pieces_and_both_kinds_of_merge(text):
    assert ids(B.Coder(PATH, P.PATTERN).text(text)) == ids(CODER.text(text)) == LIB.encode_ordinary(text)


def test_neighbours_that_fit_are_the_encoding():
    """The proof's claim: pairs that are encodings of their own make up the encoding of all."""
    r = random.Random(5)
    for _ in range(300):
        left, right = (CODER.merge("".join(r.choices("abetinng東é", k=r.randint(1, 12))).encode()) for _ in "xy")
        joined = CODER.join(left, right)
        assert joined == CODER.merge(b"".join(CODER.tokens[t] for t in left + right))
        if CODER.fits(left[-1], right[0]):
            assert joined == left + right


TEXTS = ["", None, "One two  three", "nospacesatall" * 40, ("word and word's " * 30).strip(), "x" * 70 + " " + "y" * 70, "東京 " * 60, "x" * 70 + " " + "y" * 70]


@pytest.mark.parametrize("segment", [7, 64, 1 << 16])
def test_documents_of_any_length_repeated_rows_and_clashing_names(spark, segment):
    rows = [*enumerate(TEXTS), (2, TEXTS[2]), (4, TEXTS[4]), (None, TEXTS[4])]
    docs = spark.createDataFrame([(i, t, "k", 5) for i, t in rows], "doc_id long, text string, k1 string, seg_no int")
    got = B.encode_documents(spark, docs, PATH, P.PATTERN, segment=segment, leaf=4)
    assert got.columns == ["doc_id", "text", "k1", "seg_no", "ids"]
    found = sorted(((r["doc_id"], r["text"], ids(r["ids"]["ids"])) for r in got.collect()), key=repr)
    back = got.select(B.decoded(got["ids.ids"], PATH, P.PATTERN).alias("x"), "ids.bytes", "text").collect()
    assert all(bytes(r["x"]) == bytes(r["bytes"]) == (r["text"] or "").encode() for r in back)
    assert found == sorted(((i, t, LIB.encode_ordinary(t or "")) for i, t in rows), key=repr)
    for r in B.token_digests(spark, docs, PATH, P.PATTERN, segment=segment).collect():
        if r["doc_id"] is not None:
            t = TEXTS[r["doc_id"]] or ""
            own = np.array(LIB.encode_ordinary(t), "<u4")
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(own), hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_empty_table(spark):
    assert B.token_digests(spark, spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).collect() == []
