"""Tables on storage: schemas of the stores and partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

VECTOR_TABLE = "id string, content string, metadata string, embedding array<float>"
TEXT_TABLE = "id string, content string, metadata string"
CHAT_TABLE = "session_id string, seq bigint, ts timestamp, message string"


def write_by_month(df: DataFrame, path: str, ts: str = "ts", mode: str = "overwrite", slices: int = 16) -> None:
    """Store by month of a timestamp, so that time filters prune folders.

    A busy month is written by several tasks, one per slice.
    """
    (
        df.withColumn("month", F.date_format(ts, "yyyyMM"))
        .repartition("month", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
        .write.mode(mode)
        .partitionBy("month")
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Rows of a range of months ``yyyyMM``; other folders are not listed."""
    # The folder name reads back as a number unless it is quoted as text.
    months = spark.read.option("basePath", path).parquet(path)
    return months.filter(F.col("month").between(int(first), int(last)))
