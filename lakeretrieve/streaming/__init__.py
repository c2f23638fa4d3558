"""Structured Streaming forms of the stores and indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeretrieve.functions.text import DEFAULT_ANALYZER
from lakeretrieve.plans.cells import assign_cells, write_index
from lakeretrieve.plans.changelog import ChangeLog
from lakeretrieve.plans.postings import build_postings, write_postings


def stream_upserts(changes: DataFrame, log: ChangeLog, checkpoint: str, order: str = "ord") -> StreamingQuery:
    """Upserts from a stream into a change log, one log batch per micro-batch.

    A micro-batch that is replayed after a failure replaces its own batch. The
    stream numbers the batches, so it is the only writer of its log.
    """

    def write(batch: DataFrame, number: int) -> None:
        log.put(batch, order=order, ts=F.col("ts"), batch=number)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_postings(
    documents: DataFrame, path: str, checkpoint: str, analyzer: str = DEFAULT_ANALYZER
) -> StreamingQuery:
    """Postings of new documents, each micro-batch under its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        write_postings(build_postings(batch, analyzer), f"{path}/batch={number}")

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_cells(corpus: DataFrame, model, path: str, checkpoint: str) -> StreamingQuery:
    """New vectors assigned to the cells of a trained index."""

    def write(batch: DataFrame, number: int) -> None:
        write_index(assign_cells(batch, model), f"{path}/batch={number}")

    return (
        corpus.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_messages(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Chat stream without repeats of ``(session_id, seq)``.

    The watermark bounds the state: a repeat is recognised within ``delay``.
    """
    return (
        log.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(["session_id", "seq"])
    )


def stream_chat(log: DataFrame, path: str, checkpoint: str, delay: str = "1 hour") -> StreamingQuery:
    """Append a chat stream to a table, repeats dropped."""
    return (
        distinct_messages(log, delay)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
