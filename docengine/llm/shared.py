"""Places and small DataFrame helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _steady_memory() -> None:
    """Let arrays over 4 MB go back to the system as soon as they are freed, in the driver and in workers."""
    import ctypes

    if hasattr(c := ctypes.CDLL(None), "mallopt"):
        c.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD; left to itself it grows with what is freed
        c.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
        pa.set_memory_pool(pa.system_memory_pool())  # Arrow's own pool keeps what it has had


_steady_memory()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A folder of our own is set only in a local session that names none, as in
    tests; on a cluster executors would not see it, so a missing name is an error there.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="docengine-shared-")
        spark.conf.set("spark.checkpoint.dir", place)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place


#: Spark's setting by which a query removes its shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    This cuts the lineage at a point that outlives any executor. Spark removes the shuffle
    files of the query when it ends: nothing reads them again.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return the driver's free memory to the system after a model was fitted there."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
        trim.malloc_trim(0)


def crc_mod(col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def tasks_for(spark: SparkSession, rows: float, per_task: float) -> int:
    """A number of partitions that grows with ``rows`` and keeps cores busy."""
    return int(max(spark.sparkContext.defaultParallelism, -(-rows // per_task)))


def string_buffers(column: pa.ChunkedArray | pa.Array) -> tuple[bytes, list[int]]:
    """UTF-8 bytes of a string column back to back, with ``len + 1`` offsets; nulls are empty."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = b"" if data is None else memoryview(data)[off[0] : off[-1]]
    return raw, off - off[0]


#: Least and most bits of a slot table; between them it has SLOTS_EACH slots an id.
SLOT_BITS, SLOTS_EACH = (20, 27), 16


def in_slots(spark: SparkSession, ids: DataFrame, column: Column) -> Column:
    """Whether ``column`` may be among ``ids`` (one column of longs): never false for one that is.

    A table of bits by the id's hash, which grows with the number of ids to
    2**27 bits (16 MB): a reducer to put before an exact join, which then moves
    few other rows. The slots come to the driver as packed bits of whole ranges.
    """
    import numpy as np

    bits = min(max((SLOTS_EACH * ids.count()).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)).cast("int")
    part = 1 << 16

    def pack(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            s = np.unique(batch.column(0).to_numpy())
            for r in np.unique(s // part).tolist():
                held.setdefault(r, np.zeros(part, bool))[s[s // part == r] % part] = True
        for r, b in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([np.packbits(b).tobytes()])], ["range", "bits"])

    used = ids.select(slot(F.col(ids.columns[0])).alias("s")).distinct()
    used = used.repartition(max(1, (1 << bits) // part // 64), F.shiftright("s", 16)).mapInArrow(pack, "range int, bits binary")
    table = np.zeros((1 << bits) // part * (part // 8), np.uint8).reshape(-1, part // 8)
    for r, b in zip(*used.toArrow().to_pydict().values(), strict=True):
        table[r] |= np.frombuffer(b, np.uint8)
    held = spark.sparkContext.broadcast(table.ravel())

    def hit(slots: pa.Array) -> pa.Array:
        s = slots.to_numpy(zero_copy_only=False)
        return pa.array(held.value[s >> 3] >> (7 - (s & 7)) & 1 == 1)

    hit.__annotations__ = {"slots": pa.Array, "return": pa.Array}
    return F.arrow_udf(hit, "boolean")(slot(column))
