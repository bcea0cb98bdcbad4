"""Contiguous shards of equal bytes, from prefix sums over range partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage, text_of


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a partition and sum the sizes before each of them."""
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy(zero_copy_only=False)
        upto = np.cumsum(size)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "size": batch.column("size"), "text_crc32": batch.column("text_crc32"),
            "part": np.full(len(size), part, np.int32), "at": rows + np.arange(len(size), dtype=np.int64),
            "before": total + upto - size,
        })
        if len(size):
            rows, total = rows + len(size), total + int(upto[-1])


def byte_shards(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into ``shards`` contiguous ranges of the id with nearly equal bytes.

    A row's size is the UTF-8 length of its text plus ``overhead``. Rows are ordered by id (null first), size and
    checksum in range partitions; the totals of the partitions give each its place in the whole, and a row belongs to
    the shard in whose equal share of all bytes its middle falls. So a shard is off its share by one row's size at each
    end. ``slot`` numbers the rows of a shard from 0.

    One shuffle of narrow rows; the driver sees one row per partition and one per shard. Null texts count as empty,
    repeated rows each get a slot of their own, equal ids stand next to each other (a last key spreads a common id over
    partitions), a row larger than a share leaves neighbouring shards empty, no rows give no rows. Other columns of
    ``docs`` are not read.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    keys = ["doc_id", "size", "text_crc32", "copy"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("copy"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    laid = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _running, f"doc_id {kind}, size bigint, text_crc32 bigint, part int, at bigint, before bigint"))

    bytes_before = rows_before = 0
    starts = []
    for part, n, total in sorted(laid.groupBy("part").agg(F.count("*"), F.sum("size")).collect()):
        starts.append((part, bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + total, rows_before + n
    offsets = spark.createDataFrame(starts, "part int, bytes_before bigint, rows_before bigint")

    middle = 2 * (F.col("bytes_before") + F.col("before")) + F.col("size")
    dealt = laid.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("at")).alias("row"),
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / F.lit(max(1, 2 * bytes_before)))).cast("int").alias("shard"),
    )
    firsts = dealt.groupBy("shard").agg(F.min("row").alias("first"))
    return dealt.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
