"""Incremental jobs on Structured Streaming. Each run takes what arrived since the last one and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import doc_chunk
from ..session import cut_lineage
from ..sources.keyed_table import CHANGE, DELETE, VERSION, KeyedTable, matching


def file_stream(spark: SparkSession, path: str, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files of a folder; the schema is taken from the files that are there.

    ``glob`` picks what the folder holds: single files, or tables of many files in folders of their own.
    """
    stream = spark.readStream
    if glob is not None:
        path = f"{path}/{{{glob}}}"  # as a pattern: a stream does not take the plain path of a single file
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.schema(spark.read.parquet(path).schema).parquet(path)


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything available in micro-batches and stop."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def incremental_copy(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the new rows to a Parquet table; the file sink commits each batch exactly once."""
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
        .option("path", target).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def follow_feed(feed: DataFrame, apply: Callable[[DataFrame], None], checkpoint: str) -> None:
    """Hand each batch of a change feed to ``apply``, in the order it was written.

    ``apply`` has to give the same state when a batch comes again, as replacing rows by key does.
    """
    run_available(feed, lambda batch, _: apply(batch), checkpoint)


def chunk_changes(table: KeyedTable, key: str = "doc_id", text: str = "text") -> Callable[[DataFrame], None]:
    """Keep a table of chunks, keyed by document, in step with a feed of documents: chunks of changed and deleted ones go.

    Only documents with several rows in a batch are brought together, to find the last one; the others are cut where they lie.
    """

    def apply(feed: DataFrame) -> None:
        several = cut_lineage(feed.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(key))
        last = F.max_by(F.struct(F.col(text).alias("text"), CHANGE), VERSION)
        lasts = matching(feed, several, (key,), "left_semi").groupBy(key).agg(last.alias("_l")).select(key, "_l.*")
        single = matching(feed, several, (key,), "left_anti").filter(F.col(VERSION).isNotNull()).select(key, F.col(text).alias("text"), CHANGE)
        docs = single.unionByName(lasts).filter(F.col(CHANGE) != DELETE)
        table.swap(feed.select(key), doc_chunk(docs, key, "text"))

    return apply


def batch_writer(target: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Store what is built from each batch in a folder of the batch's own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # A batch that is tried again replaces its own folder, so rows never double.
        build(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return write


def stream_chunks(docs: DataFrame, target: str, checkpoint: str, key: str = "doc_id", text: str = "text") -> None:
    """Chunk the documents that arrived since the last run."""
    run_available(docs, batch_writer(target, lambda b: doc_chunk(b, key, text)), checkpoint)


def current_chunks(spark: SparkSession, target: str, key: str = "doc_id") -> DataFrame:
    """Chunks of the latest version of every document; chunks of older versions are gone."""
    chunks = spark.read.option("basePath", target).parquet(target)
    latest = chunks.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return chunks.join(latest, [key, "batch_id"], "left_semi").drop("batch_id")
