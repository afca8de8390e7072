import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
from docengine.llm import tokens as T  # noqa: E402
from docengine.llm.shared import shared_dir  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
TEXTS = ["", "a", "  leading and   inner\n\n\tspaces  ", "don't you'll 'tis ''s I'm x're 're' 'l 'll", "naïve Ünïcode 東京 ½ ² ①    x　y", "1234 12a b3_c__ <|endoftext|> !!! ?", "word " * 3000, "'s", " 's", "'", "x'", "\n \n", "a  b", "é́ zero​width 😀😀 x", "\r\n x \x1f \x85 y"]


def direct(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [np.array([*x.ids, 0], "<u4") for x in t.encode_batch(texts, add_special_tokens=False)]


def test_encoding_equals_the_library_on_fuzzed_texts():
    rng = random.Random(7)
    alphabet = ["'", "s", "t", "re", "ll", "ve", "d", "m", " ", "  ", "\n", "\t", "1", "²", "é", "東", "_", "!", " ", "A", "x", "́"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    got = list(T.encode_documents(pa.array([*texts, None]), PATH))
    for x, a, b in zip(texts, got, direct(texts), strict=False):
        assert a.tolist() == b.tolist(), repr(x)
    assert got[-1].tolist() == [0]


def test_memo_can_be_dropped_midway(monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 3)
    monkeypatch.setattr(T, "SLICE_BYTES", 20)
    assert [x.tolist() for x in T.encode_documents(pa.array(TEXTS), PATH)] == [x.tolist() for x in direct(TEXTS)]


def test_files_round_trip_with_ties_nulls_and_extra_columns(spark):
    rows = [(i * 3 % 17, t, i) for i, t in enumerate(TEXTS)] + [(3, "again", 1), (3, "again", 1), (None, "no id", 0), (50, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    target = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    T.write_token_files(spark, df, target, PATH, shard_rows=5)
    got = T.read_token_files(spark, target, with_ids=True).collect()
    assert len(got) == len(rows)
    want = sorted(zip([r[0] for r in rows], direct([r[1] or "" for r in rows]), strict=True), key=lambda r: -1 if r[0] is None else r[0])
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == [r[0] for r in want]
    at = 0
    for r in by_start:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert sorted(tuple(r["ids"]) for r in got) == sorted(tuple(x.tolist()) for _, x in want)
    block = spark.read.parquet(f"{target}/shards").where("size(doc_ids) > 1").first().asDict()
    d = spark.read.parquet(f"{target}/dictionary").first()
    assert d["dict_hash"] == block["dict_hash"] == zlib.crc32(bytes(d["dictionary"]))
    assert len(T.read_document(block, 1, bytes(d["dictionary"]))) == block["n_tokens"][1]


def test_empty_table(spark):
    assert T.token_output(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_added_tokens_have_their_ids(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "x<|endof", "text|> y", "<|endoftext|><|endoftext|> é", "plain"]
    want = [[*x.ids, 0] for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in T.encode_documents(pa.array(texts), PATH, added=True)] == want
    got = T.token_output(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), PATH).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(want)}
    assert [64, 220, 50256, 275, 0] in want


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(T, "span_hashes", lambda values, starts, ends: (values[starts] % np.uint64(7)).astype(np.uint64))
    T._coders.clear()
    assert [x.tolist() for x in T.encode_documents(pa.array(TEXTS), PATH)] == [x.tolist() for x in direct(TEXTS)]
    T._coders.clear()


def test_words_of_equal_letters_and_a_heavy_id(spark):
    t = "a"
    for _ in range(10):
        t += t.translate(str.maketrans("ab", "ba"))
    u = t.translate(str.maketrans("ab", "ba"))
    texts = [t, u, t + " " + u]
    assert [x.tolist() for x in T.encode_documents(pa.array(texts), PATH)] == [x.tolist() for x in direct(texts)]
    rows = [(7, f"text {i} of one id") for i in range(60)] + [(i, "other") for i in range(20)]
    target = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    T.write_token_files(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), target, PATH, shard_rows=10)
    got = sorted(T.read_token_files(spark, target).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in rows)
    assert spark.read.parquet(f"{target}/shards").where("array_contains(doc_ids, 7)").select("shard").distinct().count() > 2


def test_long_documents_train_the_dictionary(spark):
    docs = spark.createDataFrame([(i, f"number {i} " + "some words that come again and again " * 900) for i in range(20)], "doc_id long, text string")
    assert T.train_dictionary(docs, PATH).startswith(b"7\xa40\xec")  # the magic number of a dictionary


def test_full_memo_keeps_the_pieces_met_again(monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 40)
    monkeypatch.setattr(T, "SLICE_BYTES", 60)
    T._coders.clear()
    learned, learn = [], T._Coder.learn
    monkeypatch.setattr(T._Coder, "learn", lambda self, h, b, starts, ends: (learned.extend(bytes(b[i:j]) for i, j in zip(starts, ends, strict=True)), learn(self, h, b, starts, ends))[1])
    texts = [f"often é come some words {i}x{i * i} 東{i} once{i:b}" for i in range(300)]
    assert [x.tolist() for x in T.encode_documents(pa.array(texts), PATH)] == [x.tolist() for x in direct(texts)]
    assert learned.count(b" words") == 1 and learned.count(b"often") == 1
    T._coders.clear()
