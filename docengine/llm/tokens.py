"""Token-ID output: one zstandard frame per document under a shared dictionary.

File format: a Parquet table of shards. A shard covers a range of doc_id and is
one row per block of documents: ``shard, block, first_token, dict_hash, doc_ids,
n_tokens, crc32, offsets, payload``; ``first_token`` counts ids before the block in its shard. ``payload`` is the frames back to back, ``offsets`` has one more
entry than the block has documents, so a single short document is read by one
slice and one decompression. The dictionary is a table of its own beside it.
Ids are stored as little-endian unsigned 32-bit integers inside the frames.

Defined cases: a null text is the empty text and has the end id only; rows that
repeat are all written; documents are in ascending doc_id order, null ids
first; an empty input gives files without blocks. Other columns are ignored. The
literal of a token that the tokenizer's file adds (such as an end-of-text sign) is
that token's id in ``token_output``, as in the library by default; the functions
below spell it out as text unless ``added`` is set.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialize, shared_dir, string_buffers, tasks_for
from .textkit import U64, equal_spans, span_hashes

END_ID = 0
#: Documents whose id arrays train the dictionary, and its size.
DICT_SAMPLE, DICT_BYTES, DICT_LONGEST = 2000, 64 << 10, 20_000
#: Documents that train it at least, however long, and bytes of the pieces that few are cut to.
DICT_FEW, DICT_PIECE = 16, 4096
BLOCK_BYTES = 192 << 10
SLICE_BYTES = 1 << 20
#: Distinct pieces that a worker remembers.
MEMO_PIECES = 500_000
#: Bits of the table of slots that finds most of them at once.
SLOT_BITS = 21

_classes: list[np.ndarray] = []
_coders: dict[str, _Coder] = {}


def _class_table() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, for every code point."""
    if not _classes:
        import regex

        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
        table = np.zeros(0x110000, np.uint8)
        for k, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[m.start() : m.end()] = k
        _classes.append(table)
    return _classes[0]


def pieces(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the byte-level pattern, over many documents.

    The pattern is: contractions, letters, numbers and other signs with at most
    one space before them, white space that no sign follows, white space. It is
    laid out here as boundary rules on arrays of code points.
    """
    n = len(points)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    kind = _class_table()[points]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | edge[1:-1]
    begin = change.copy()
    follows = np.zeros(n, bool)  # the next code point is of the same document and no white space
    follows[:-1] = ~edge[1:-1] & (kind[1:] != 3)
    tail = (kind == 3) & follows  # last white space of a run before a sign
    begin |= tail
    glued = np.zeros(n, bool)  # the first code point after a lone space that joins it
    glued[1:] = tail[:-1] & (points[:-1] == 32)
    begin &= ~glued
    # contractions: a quote that starts a piece, directly before letters
    quote = np.flatnonzero((points == 39) & begin & np.append(kind[1:] == 1, False) & ~edge[1:])
    if len(quote):
        pad = np.append(points, [0, 0])
        one, two = pad[quote + 1], pad[quote + 2]
        inside = ~edge[np.minimum(quote + 2, n)]  # a second letter of the same document
        pair = inside & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
        single = np.isin(one, [115, 116, 109, 100])
        taken = np.where(single, 2, np.where(pair, 3, 0))
        at, size = quote[taken > 0], taken[taken > 0]
        begin[at + 1] = False
        after = at + size
        ok = after < n
        begin[after[ok]] |= kind[after[ok]] == 1
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], n)


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of slices, back to back."""
    stop = np.cumsum(size)
    return np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(start - (stop - size), size)


class _Coder:
    """Encodes texts with the tokenizers library, piece by distinct piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        vocabulary = self.tok.get_vocab()
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # one sign of a byte-level token is one byte
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, U64)  # sorted hashes
        self.row = np.zeros(0, np.int64)  # of each, its place in begin
        self.hash = np.zeros(0, U64)  # of each row
        self.again = np.zeros(0, bool)  # whether it was met again after it was learned
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)  # rows by the top bits of their hashes, first come
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint16)
        self.edge = np.zeros(1, np.int64)  # bytes of each row, to tell pieces of one hash apart
        self.data = np.zeros(0, np.uint8)

    def with_added(self, raw, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """Ids of the documents that hold an added token, which pieces cannot see: whole texts by the library."""
        data, got = bytes(raw), {}
        for content in self.added:
            at = data.find(content)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, side="right")) - 1
                text = data[offsets[k] : offsets[k + 1]]
                if content in text:  # else it is put together by two documents
                    self.tok.encode_special_tokens = False  # one tokenizer for both: a second one takes memory
                    got[k] = np.array(self.tok.encode(text.decode("utf-8"), add_special_tokens=False).ids, "<u4")
                    self.tok.encode_special_tokens = True
                    at = data.find(content, int(offsets[k + 1]))
                else:
                    at = data.find(content, at + 1)
        return got

    def learn(self, hashes: np.ndarray, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add pieces by the library: all in one call, as words that are split already."""
        size = ends - starts
        data = b[_flat(starts, size)]
        text = data.tobytes().decode("utf-8")
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[np.cumsum(size)].tolist()
        split = [text[i:j] for i, j in zip([0, *at], at, strict=False)]
        flat = np.array(self.tok.encode_batch_fast([split], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64)
        told = np.cumsum(self.width[flat])  # bytes of the tokens tell which piece they are of
        if len(told) and told[-1] == len(data):
            count = np.searchsorted(told, np.cumsum(size), side="right")
        else:  # a vocabulary without some bytes
            count = np.cumsum(np.bincount(np.array(self.tok.encode(split, is_pretokenized=True, add_special_tokens=False).word_ids, np.int64), minlength=len(hashes)))
        wide = np.uint16 if self.ids.dtype == np.uint16 and (not len(flat) or flat.max() < 65536) else np.uint32
        rows = len(self.begin) - 1 + np.arange(len(hashes))
        self.begin = np.concatenate([self.begin, self.begin[-1] + count])
        self.ids = np.concatenate([self.ids.astype(wide), flat.astype(wide)])
        self.edge = np.concatenate([self.edge, self.edge[-1] + np.cumsum(size)])
        self.data = np.concatenate([self.data, data])
        self.hash = np.concatenate([self.hash, hashes])
        self.again = np.concatenate([self.again, np.zeros(len(hashes), bool)])
        to = np.searchsorted(self.known, hashes)  # both are sorted
        self.known, self.row = np.insert(self.known, to, hashes), np.insert(self.row, to, rows)
        slot = (hashes >> U64(64 - SLOT_BITS)).astype(np.int64)
        free = self.slots[slot] < 0
        self.slots[slot[free]] = rows[free]

    def shrink(self) -> None:
        """Forget the pieces that were met once, or all if too many others are left."""
        keep = np.flatnonzero(self.again)
        hashes, ids, data = self.hash[keep], self.ids, self.data
        of_ids, of_data = ((x[keep], x[keep + 1] - x[keep]) for x in (self.begin, self.edge))
        self.clear()
        if 2 * len(keep) > MEMO_PIECES:
            return
        self.begin, self.edge = (np.concatenate([[0], np.cumsum(n)]) for _, n in (of_ids, of_data))
        self.ids, self.data, self.hash, self.again = ids[_flat(*of_ids)], data[_flat(*of_data)], hashes, np.zeros(len(keep), bool)
        self.row = np.argsort(hashes)
        self.known = hashes[self.row]
        self.slots[(hashes >> U64(64 - SLOT_BITS)).astype(np.int64)[::-1]] = np.arange(len(keep))[::-1]

    def rows(self, h: np.ndarray, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each piece; new ones are learned."""
        if len(self.begin) > MEMO_PIECES:
            self.shrink()
        old = len(self.hash)
        row = self.slots[(h >> U64(64 - SLOT_BITS)).astype(np.int64)].astype(np.int64)
        miss = np.flatnonzero(row < 0) if not len(self.hash) else np.flatnonzero((row < 0) | (self.hash[row] != h))
        if len(miss):
            distinct, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, distinct)
            new = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != distinct) if len(self.known) else np.arange(len(distinct))
            if len(new):
                own = miss[first[new]]
                self.learn(distinct[new], b, starts[own], ends[own])
                at = np.searchsorted(self.known, distinct)
            row[miss] = self.row[at][inverse]
        self.again[row[row < old]] = True
        return row

    def encode(self, raw, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents back to back, without end ids, and offsets."""
        data = bytes(raw)
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        b = np.frombuffer(data, np.uint8)
        head = (b & 0xC0) != 0x80
        heads = np.zeros(len(b) + 1, np.int64)
        np.cumsum(head, out=heads[1:])
        starts, ends = pieces(points, heads[offsets])
        place = np.append(np.flatnonzero(head), len(b))  # of each code point's first byte
        starts, ends = place[starts], place[ends]
        row = self.rows(span_hashes(b, starts, ends), b, starts, ends)
        size = self.begin[row + 1] - self.begin[row]
        total = np.concatenate([[0], np.cumsum(size)])
        ids, edges = self.ids[_flat(self.begin[row], size)].astype("<u4"), total[np.searchsorted(starts, offsets)]
        # every piece is compared with the one that its hash stands for
        same = self.edge[row + 1] - self.edge[row] == ends - starts
        fit = np.flatnonzero(same)
        same[fit] = equal_spans(b, starts[fit], self.data, self.edge[row[fit]], (ends - starts)[fit])
        if same.all():
            return ids, edges
        wrong = set((np.searchsorted(offsets, starts[~same], side="right") - 1).tolist())
        texts = [np.array(self.tok.encode(data[i:j].decode("utf-8"), add_special_tokens=False).ids, "<u4") if k in wrong else ids[edges[k] : edges[k + 1]] for k, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))]
        return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def coder(path: str) -> _Coder:
    if path not in _coders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[path] = _Coder(path)
    return _coders[path]


def _forget() -> None:
    """Give the encoder's memory back: this worker now does other work."""
    if _coders:
        import ctypes

        _coders.clear()
        _classes.clear()
        ctypes.CDLL(None).malloc_trim(0)


def encode_documents(column: pa.Array | pa.ChunkedArray, path: str, end_id: int = END_ID, added: bool = False):
    """The id array of each text, with the end id; ``added``: literals of added tokens are their ids."""
    raw, off = string_buffers(column)
    end = np.array([end_id], "<u4")
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        ids, at = coder(path).encode(raw[off[i] : off[j]], off[i : j + 1] - off[i])
        whole = coder(path).with_added(raw[off[i] : off[j]], off[i : j + 1] - off[i]) if added else {}
        for k in range(j - i):
            yield np.concatenate([whole[k] if k in whole else ids[at[k] : at[k + 1]], end])
        i = j


def train_dictionary(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", sample: int = DICT_SAMPLE, size: int = DICT_BYTES, added: bool = False) -> bytes:
    """A zstandard dictionary from the id arrays of about ``sample`` documents.

    Which documents: those of the smallest hashes of their ids, by a threshold. Texts of more than ``DICT_LONGEST``
    characters are left to others; where fewer than ``DICT_FEW`` are left, the shortest of the longer ones are taken, whole.
    Few arrays are cut to pieces for the training, which wants many. With too little
    text to train on, the dictionary is empty. The arrays' order does not depend on the rows'.
    """
    import zstandard

    u = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    picked = docs.where(u < sample / max(1, docs.count())).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), F.xxhash64(F.col(id_col)).alias("h"))
    short = F.char_length("t") <= DICT_LONGEST
    chosen = picked.where(short).orderBy("h", "t").limit(2 * sample).select("t").toArrow().sort_by("t")
    if chosen.num_rows < DICT_FEW:
        longer = picked.where(~short).orderBy(F.char_length("t"), "h", "t").limit(DICT_FEW - chosen.num_rows).select("t").toArrow().sort_by("t")
        chosen = pa.concat_tables([chosen, longer])
    arrays = [x.tobytes() for x in encode_documents(pa.chunked_array(chosen.column("t").chunks, chosen.column("t").type), path, added=added)]
    if len(arrays) < 8 * DICT_FEW:
        arrays = [x[i : i + DICT_PIECE] for x in arrays for i in range(0, len(x), DICT_PIECE)]
    del picked, chosen
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""
    finally:
        del arrays
        _forget()


def _frames(dictionary: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=d), zstandard.ZstdDecompressor(dict_data=d)


def write_token_files(spark: SparkSession, docs: DataFrame, target: str, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_rows: int = 20_000, added: bool = False) -> None:
    """Write the files of ``docs`` under ``target``: ``target/dictionary`` and ``target/shards``.

    Texts are encoded and compressed where they lie; only frames are shuffled,
    to shards cut at quantiles of the id, and sorted within them.
    """
    dictionary = train_dictionary(docs, path, id_col=id_col, text_col=text_col, added=added)
    dict_hash = zlib.crc32(dictionary)
    spark.createDataFrame([(dict_hash, dictionary)], "dict_hash long, dictionary binary").coalesce(1).write.parquet(f"{target}/dictionary")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    n = ids.count()
    shards = tasks_for(spark, n, shard_rows)
    cuts = np.array(sorted(ids.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(-(1 << 63))), [k / shards for k in range(1, shards)], 10 * shards + 1000)).first()[0] or []) if n and shards > 1 else [], np.int64)
    many = int(len(cuts) + 1)

    def shard_of(doc_ids, crc):
        """An id between two cuts is in one shard; one that is several cuts itself is dealt over their shards by checksum."""
        a, b = np.searchsorted(cuts, doc_ids, side="left"), np.searchsorted(cuts, doc_ids, side="right")
        return a + np.where(b > a + 1, ((b - a) * crc) >> 32, 0)

    def encode(batches):
        for batch in batches:
            press = _frames(dictionary)[0]
            rows = [[], [], []]
            for x in encode_documents(batch.column(1), path, end_id, added):
                b = x.tobytes()
                rows[0].append(len(x))
                rows[1].append(zlib.crc32(b))
                rows[2].append(press.compress(b))
            at = shard_of(batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), np.array(rows[1], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], ["shard", "doc_id", "n", "crc", "frame"])

    def blocks(batches):
        """Sorted frames to blocks; a block ends with its shard or at BLOCK_BYTES."""
        block = {}
        keep: list = []

        def flush():
            s = keep[0][0]
            k, first = block.get(s, (0, 0))
            block[s] = k + 1, first + sum(r[2] for r in keep)
            size = [len(r[4]) for r in keep]
            return pa.RecordBatch.from_pylist([{"shard": s, "block": k, "first_token": first, "dict_hash": dict_hash, "doc_ids": [r[1] for r in keep], "n_tokens": [r[2] for r in keep], "crc32": [r[3] for r in keep], "offsets": [0, *np.cumsum(size).tolist()], "payload": b"".join(r[4] for r in keep)}], schema=arrow)

        _forget()
        held = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keep and (keep[0][0] != r[0] or held >= BLOCK_BYTES):
                    yield flush()
                    keep.clear()
                    held = 0
                keep.append(r)
                held += len(r[4])
        if keep:
            yield flush()

    arrow = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_token", pa.int64()), ("dict_hash", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("crc32", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])
    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(encode, "shard int, doc_id long, n long, crc long, frame binary")
        .repartitionById(many, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "crc", "n")
        .mapInArrow(blocks, "shard int, block int, first_token long, dict_hash long, doc_ids array<long>, n_tokens array<long>, crc32 array<long>, offsets array<long>, payload binary")
        .write.parquet(f"{target}/shards")
    )


def read_token_files(spark: SparkSession, source: str, *, with_ids: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    Every frame is decompressed; its length and checksum must agree with the
    index, else the read fails.
    """
    dictionary = {r[0]: bytes(r[1]) for r in spark.read.parquet(f"{source}/dictionary").collect()}
    shards = spark.read.parquet(f"{source}/shards")
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = shards.groupBy("shard").agg(F.sum(size).alias("n"))
    # one row per shard of thousands of documents; a running total over these few
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    # written, so that its size is known and Spark can tell whether to broadcast it
    bases = materialize(spark, sums.select("shard", F.coalesce(before, F.lit(0)).alias("base")), "bases")
    shards = shards.join(bases, "shard")

    def read(batches):
        _forget()
        for batch in batches:
            for row in batch.to_pylist():
                press = _frames(dictionary[row["dict_hash"]])[1]
                at = row["base"] + row["first_token"]
                out = [[], [], [], [], []]
                for k, doc in enumerate(row["doc_ids"]):
                    b = press.decompress(row["payload"][row["offsets"][k] : row["offsets"][k + 1]])
                    crc = zlib.crc32(b)
                    if len(b) != 4 * row["n_tokens"][k] or crc != row["crc32"][k]:
                        raise ValueError(f"frame of document {doc} does not match its index")
                    for column, x in zip(out, (doc, at, len(b) // 4, crc, np.frombuffer(b, "<u4").tolist() if with_ids else []), strict=True):
                        column.append(x)
                    at += len(b) // 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(),) * 4 + (pa.list_(pa.int64()),), strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    out = shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if with_ids else out.drop("ids")


def read_document(row: dict, k: int, dictionary: bytes) -> np.ndarray:
    """The ids of document ``k`` of one block row, touching only its own frame."""
    b = _frames(dictionary)[1].decompress(bytes(row["payload"])[row["offsets"][k] : row["offsets"][k + 1]])
    return np.frombuffer(b, "<u4")


def token_output(spark: SparkSession, docs: DataFrame, path: str, target: str | None = None) -> DataFrame:
    """Write the files, read them back, and return the digest of each document."""
    target = target or f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(spark, docs, target, path, added=True)
    return read_token_files(spark, target)
