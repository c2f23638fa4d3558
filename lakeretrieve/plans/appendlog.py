"""Append-only tables with tombstones, and folders numbered by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def batch_numbers(spark: SparkSession, path: str, name: str = "batch") -> list[int]:
    """Numbers of the ``<name>=<n>`` folders below a path, ascending."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))


class AppendTable:
    """Rows that are appended and deleted by id, never updated.

    A delete appends the ids. The current table is the rows without a later
    tombstone: an outer join with one row per deleted id, which Spark
    broadcasts while it is small, and no aggregate over the rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, id_col: str = "id"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.id_col = id_col
        self.columns = spark.createDataFrame([], schema).columns

    def last_batch(self) -> int:
        """Number of the newest change, -1 for an empty table."""
        used = batch_numbers(self.spark, f"{self.path}/rows") + batch_numbers(self.spark, f"{self.path}/gone")
        return max(used, default=-1)

    def _next(self) -> int:
        return self.last_batch() + 1

    def append(self, rows: DataFrame, batch: int | None = None) -> int:
        batch = self._next() if batch is None else batch
        rows.select(*self.columns).write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
        return batch

    def delete(self, ids: DataFrame, batch: int | None = None) -> int:
        batch = self._next() if batch is None else batch
        ids.select(self.id_col).distinct().write.mode("overwrite").parquet(f"{self.path}/gone/batch={batch}")
        return batch

    def _read(self, part: str, schema: str) -> DataFrame:
        if not batch_numbers(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], f"{schema}, batch bigint")
        return self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.path}/{part}")

    def _live(self, since: int) -> DataFrame:
        rows = self._read("rows", self.schema).filter(F.col("batch") > since)
        if not batch_numbers(self.spark, f"{self.path}/gone"):
            return rows.select(*self.columns)
        last = self._gone(-1).groupBy(self.id_col).agg(F.max("batch").alias("__gone"))
        live = rows.join(last, self.id_col, "left").filter(
            F.col("__gone").isNull() | (F.col("batch") > F.col("__gone"))
        )
        return live.select(*self.columns)

    def _gone(self, since: int) -> DataFrame:
        kind = self.spark.createDataFrame([], self.schema).schema[self.id_col].dataType.simpleString()
        return self._read("gone", f"`{self.id_col}` {kind}").filter(F.col("batch") > since)

    def current(self) -> DataFrame:
        return self._live(-1)

    def rows_since(self, batch: int) -> DataFrame:
        """Live rows appended after a batch; only their folders are read."""
        return self._live(batch)

    def gone_since(self, batch: int) -> DataFrame:
        """Ids deleted after a batch."""
        return self._gone(batch).select(self.id_col).distinct()
