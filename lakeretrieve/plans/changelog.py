"""Mutable tables as an append-only change log.

Plain parquet tables take no row-level updates, so a change is an appended row
``(key, value columns, op, ts, batch, ord)`` with ``op`` ``put`` or ``delete``.
The current table keeps the last change of each key by ``(batch, ord)``.
Everything is a map-side combined aggregate, so one hot key costs a row per
task, not a sorted group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.plans.appendlog import batch_numbers


def last_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; of one batch, the last duplicate wins."""
    rest = [c for c in changes.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__last"))
        .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest])
    )


def apply_upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "ord"
) -> DataFrame:
    """Merge a batch into a table with ``created_at`` and ``updated_at``.

    A matched key takes the new values and keeps ``created_at``; a new key is
    created and updated at the same time. Changes have ``keys, values, ts`` and
    the order column.
    """
    batch = last_per_key(changes.select(*keys, *values, "ts", order), keys, [order]).select(
        *keys, *[F.col(v).alias(f"__new_{v}") for v in values], F.col("ts").alias("__ts"), F.lit(True).alias("__changed")
    )
    merged = current.join(batch, list(keys), "full")
    changed = F.col("__changed").isNotNull()
    return merged.select(
        *keys,
        *[F.when(changed, F.col(f"__new_{v}")).otherwise(F.col(v)).alias(v) for v in values],
        F.coalesce("created_at", "__ts").alias("created_at"),
        F.coalesce("__ts", "updated_at").alias("updated_at"),
    )


def apply_delete(current: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed; unknown keys are no error."""
    return current.join(gone.select(*keys), list(keys), "left_anti")


def current_view(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Live rows of a change log with their creation and update times.

    ``created_at`` is the first put after the last delete. Deletes are few and
    are folded to one row per key before the log is compared with them.
    """
    place = F.struct("batch", "ord")
    deleted = log.filter(F.col("op") == "delete").groupBy(*keys).agg(F.max(place).alias("__deleted"))
    puts = log.filter(F.col("op") == "put").withColumn("__place", place)
    live = puts.join(deleted, list(keys), "left").filter(
        F.col("__deleted").isNull() | (F.col("__place") > F.col("__deleted"))
    )
    return (
        live.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*values), F.col("__place")).alias("__last"),
            F.min_by("ts", F.col("__place")).alias("created_at"),
            F.max_by("ts", F.col("__place")).alias("updated_at"),
        )
        .select(*keys, *[F.col(f"__last.{v}").alias(v) for v in values], "created_at", "updated_at")
    )


class ChangeLog:
    """A change log under a path: ``batch=<n>`` folders of parquet files.

    Writing a batch number again replaces that batch, so a retried batch or a
    replayed stream leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], values: dict[str, str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.values = list(values)
        self.types = {**keys, **values, "op": "string", "ts": "timestamp", "ord": "bigint"}
        self.schema = ", ".join(f"`{name}` {kind}" for name, kind in {**self.types, "batch": "bigint"}.items())

    def _batches(self) -> list[int]:
        return batch_numbers(self.spark, self.path)

    def log(self) -> DataFrame:
        if not self._batches():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def current(self) -> DataFrame:
        return current_view(self.log(), self.keys, self.values)

    def _append(self, rows: DataFrame, batch: int | None) -> int:
        if batch is None:
            batch = max(self._batches(), default=-1) + 1
        # Casts give a null literal the type of its column.
        typed = rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in self.types.items()])
        typed.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return batch

    def put(self, rows: DataFrame, order: Column | str | None = None, ts: Column | None = None, batch: int | None = None) -> int:
        """Append puts. ``order`` ranks duplicates of a key within the batch."""
        if order is None:
            order = F.lit(0)
        order = F.col(order) if isinstance(order, str) else order
        stamped = rows.select(
            *self.keys,
            *[F.col(v) if v in rows.columns else F.lit(None).alias(v) for v in self.values],
            F.lit("put").alias("op"),
            (F.current_timestamp() if ts is None else ts).alias("ts"),
            order.alias("ord"),
        )
        return self._append(stamped, batch)

    def delete(self, keys: DataFrame, ts: Column | None = None, batch: int | None = None) -> int:
        """Append tombstones for the listed keys."""
        stamped = keys.select(
            *self.keys,
            *[F.lit(None).alias(v) for v in self.values],
            F.lit("delete").alias("op"),
            (F.current_timestamp() if ts is None else ts).alias("ts"),
            F.lit(0).alias("ord"),
        )
        return self._append(stamped, batch)

    def compact(self, path: str) -> "ChangeLog":
        """The live rows as the first batches of a new log; this one stays.

        Creation and update times survive as two puts of each key.
        """
        other = ChangeLog(
            self.spark, path, {k: self.types[k] for k in self.keys}, {v: self.types[v] for v in self.values}
        )
        live = self.current().withColumn("op", F.lit("put"))
        first = live.withColumn("ts", F.col("created_at")).withColumn("ord", F.lit(0))
        last = live.withColumn("ts", F.col("updated_at")).withColumn("ord", F.lit(1))
        other._append(first.unionByName(last), 0)
        return other
