"""A bounded sample of labelled training documents, for classifiers."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import crc_mod


#: UTF-8 bytes of all texts of a sample; one text may have a sixteenth of them. Longer ones are passed over for others, none is cut.
SAMPLE_BYTES, SHARE = 64 << 20, 16
#: Rows of each label that are taken even where no text is short enough: the shortest.
LEAST = 8


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str, limit: int, *, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_BYTES) -> tuple[pa.Array, list[int]]:
    """Whole texts and labels (0 or 1) of at most ``limit`` documents outside the held-out fold.

    Taken are the least hashes of (id, label) among documents that the table has, until their texts have
    ``most`` bytes; a text of more than a sixteenth of that is passed over, unless a label had fewer than
    LEAST rows then: of those the shortest are taken, whatever their length. A null text counts as empty. Of a document with both
    labels each counts; of one with rows of several texts, the least text. A null id is never taken. The chosen ids are sent to
    the scan, so texts of other rows are never moved.
    """
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    rows = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_mod(id_col, 5) != 0))
        .select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .distinct()
        .join(own.select("_id", F.octet_length("_t").cast("long").alias("_n")), "_id")
        .groupBy("_id", "_y")
        .agg(F.max("_n").alias("_n"))
    )
    first = rows.where(F.col("_n") <= most // SHARE).orderBy(F.xxhash64("_id", "_y"), "_id", "_y").limit(limit).collect()
    picked, size = [], 0
    for r in first:
        if size + r["_n"] <= most:
            picked.append((r["_id"], r["_y"]))
            size += r["_n"]
    if limit >= 2 * LEAST:
        for y in (0, 1):
            if sum(b == y for _, b in picked) < LEAST:
                more = rows.where((F.col("_y") == y) & (F.col("_n") > most // SHARE)).orderBy("_n", F.xxhash64("_id", "_y"), "_id").limit(LEAST).collect()
                picked += [(r["_id"], r["_y"]) for r in more]
    few = F.broadcast(spark.createDataFrame(picked, "_id long, _y int"))
    got = own.join(few, "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t")).toArrow()
    got = got.take(pc.sort_indices(got, [("_id", "ascending"), ("_y", "ascending")]))
    return got.column("_t").combine_chunks(), got.column("_y").to_pylist()
