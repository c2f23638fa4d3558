"""Streaming queries; each reads a table as a stream and returns the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeretrieve.plans import cells
from lakeretrieve.plans.changelog import ChangeLog
from lakeretrieve.registry.base import CHAT_SQL, DOC_TOKENS_SQL, Tables, query, stamp
from lakeretrieve.session import scratch_path
from lakeretrieve.streaming import stream_cells, stream_chat, stream_postings, stream_upserts


def _stream(t: Tables, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files.

    The pattern of one letter matches the table's own path only. A plain path would be
    taken for the root of partition folders, which a file cannot be.
    """
    return t.spark.readStream.schema(t.read(name).schema).parquet(f"{t.dir}/[{name[0]}]{name[1:]}.parquet")


@query(
    "s01_stream_upserts",
    """SELECT user_id AS key, arg_max(event_type, event_id) AS value, arg_max(value, event_id) AS amount,
         strftime(arg_min(ts, event_id), '%Y-%m-%d %H:%M:%S') AS created_at,
         strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS updated_at
       FROM events GROUP BY user_id""",
)
def upserts(t: Tables):
    log = ChangeLog(
        t.spark, scratch_path(t.spark, "stream-log"), {"key": "bigint"}, {"value": "string", "amount": "double"}
    )
    changes = _stream(t, "events").select(
        F.col("user_id").alias("key"),
        F.col("event_type").alias("value"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("ord"),
    )
    stream_upserts(changes, log, scratch_path(t.spark, "stream-state")).awaitTermination()
    return log.current().select(
        "key", "value", "amount", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at")
    )


@query(
    "s02_stream_postings",
    f"""WITH {DOC_TOKENS_SQL}, p AS (SELECT id, unnest(tokens) AS term FROM doc_tokens)
        SELECT term, count(DISTINCT id) AS documents, count(*) AS occurrences FROM p GROUP BY term""",
)
def postings(t: Tables):
    path = scratch_path(t.spark, "stream-postings")
    documents = _stream(t, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    stream_postings(documents, path, scratch_path(t.spark, "stream-state")).awaitTermination()
    return t.spark.read.parquet(path).groupBy("term").agg(
        F.count_distinct("id").alias("documents"), F.count(F.lit(1)).alias("occurrences")
    )


@query("s02_stream_cells", "SELECT vec_id AS id, label FROM embeddings")
def vector_cells(t: Tables):
    path = scratch_path(t.spark, "stream-cells")
    model = cells.train_centres(t.vectors, cells=8)
    rows = _stream(t, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    stream_cells(rows, model, path, scratch_path(t.spark, "stream-state")).awaitTermination()
    return t.spark.read.parquet(path).filter("cell BETWEEN 0 AND 7").select("id", "label")


@query(
    "s03_stream_chat",
    f"""WITH {CHAT_SQL} SELECT session_id, seq, type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, md5(content) AS content_md5
        FROM chat""",
)
def chat(t: Tables):
    """Every message arrives twice; one of each stays."""
    path = scratch_path(t.spark, "stream-chat")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    log = _stream(t, "conversations").select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.col("turn").alias("seq"),
        (start + F.make_dt_interval(hours=F.col("conv_id").cast("int"), mins=F.col("turn").cast("int"))).alias("ts"),
        F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "ai").otherwise(F.col("role")).alias("type"),
        F.col("text").alias("content"),
    )
    twice = log.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    stream_chat(twice, path, scratch_path(t.spark, "stream-state"), delay="365 days").awaitTermination()
    return t.spark.read.parquet(path).select(
        "session_id", "seq", "type", stamp("ts").alias("ts"), F.md5("content").alias("content_md5")
    )
