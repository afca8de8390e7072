"""Chunks of documents that arrive in any order, in any micro-batch, merged when all of a document are there.

The state of a document is its chunks so far. What they make together is worked out by the
expressions of ``operators.merge``, so a stream gives what a batch gives. A chunk that comes twice is kept
once (the last one counts); a document whose chunks do not all come in time is given as a failed row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.merge import CHUNK, batch_summary, merged_rows

#: The state store that arbitrary state needs.
STORE_KEY, STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "doc_id long, chunks array<string>, missing array<int>"


class GatherChunks(StatefulProcessor):
    """Gives the chunks of a document in order once their number is that which each of them tells."""

    def __init__(self, timeout_ms: int | None):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk_no int", "chunk string")
        self.total = handle.getValueState("total", "total int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.timeout_ms is not None and not self.total.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
        for part in rows:
            for no, total, chunk in zip(part["chunk_no"], part["n_chunks"], part["chunk"], strict=True):
                self.chunks.updateValue((int(no),), (chunk,))
                self.total.update((int(total),))
        held = dict(self._held())
        if len(held) >= self.total.get()[0]:
            for at in list(self.handle.listTimers()) if self.timeout_ms is not None else ():
                self.handle.deleteTimer(at)
            yield self._give(key, held, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.total.exists():
            held = dict(self._held())
            yield self._give(key, held, [k for k in range(self.total.get()[0]) if k not in held])

    def _held(self) -> Iterator[tuple[int, str]]:
        for no, chunk in self.chunks.iterator():
            yield no[0], chunk[0]

    def _give(self, key, held: dict[int, str], missing: list[int]) -> pd.DataFrame:
        self.chunks.clear()
        self.total.clear()
        return pd.DataFrame({"doc_id": [key[0]], "chunks": [[held[k] for k in sorted(held)]], "missing": [missing]})

    def close(self) -> None:
        pass


def merge_stream(chunks: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """doc_id, the columns of ``merge_chunks`` and error, of a stream of chunk rows with a column n_chunks.

    The session's state store must be STORE. With ``timeout_ms`` a document whose chunks are not all there after that
    time is a failed row; such a stream watches the clock and does not end by itself (as ``availableNow`` streams do without it).
    """
    fields = [x.split(" ")[0] for x in CHUNK.split(", ") if x.split(" ")[0] != "doc_id"]
    rows = chunks.select("doc_id", "chunk_no", "n_chunks", F.to_json(F.struct(*fields)).alias("chunk"))
    got = rows.groupBy("doc_id").transformWithStateInPandas(GatherChunks(timeout_ms), outputStructType=_OUT, outputMode="Append", timeMode="None" if timeout_ms is None else "ProcessingTime")
    kind = "struct<" + ",".join(x.replace(" ", ":", 1) for x in CHUNK.split(", ") if not x.startswith("doc_id ")) + ">"
    made = got.withColumn("rows", F.transform("chunks", lambda c: F.from_json(c, kind)))
    lost = F.size("missing") > 0
    error = F.when(lost, F.concat(F.lit("missing chunks: "), F.array_join(F.col("missing").cast("array<string>"), ",")))
    return made.select("doc_id", *(F.when(~lost, c).alias(n) for n, c in merged_rows(F.col("rows")).items()), error.alias("error"))


def running_summary(results: DataFrame, key: str = "filename") -> DataFrame:
    """total, successful and failed of a stream of results (key, success) so far; a document that comes again is counted once."""
    return batch_summary(results.dropDuplicates([key]))
