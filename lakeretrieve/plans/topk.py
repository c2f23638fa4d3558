"""Top-k per group and row positions, both safe for a group of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeretrieve.session import cut_lineage


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Best ``k`` rows of each group with their rank from 1.

    The ``row_number() <= k`` shape becomes a WindowGroupLimit before the
    shuffle: each map task keeps k rows of a group, so a group holding a third
    of the table still sends only k rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def with_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], position: str = "position") -> DataFrame:
    """Row position from 1 within each group, in ascending ``order``.

    A plain window would sort a whole group in one task. Here the table is
    range-partitioned on (group, order), so a large group spreads over many
    tasks; the sorted partitions are checkpointed so that row numbers stay
    fixed when a task is re-run; and the rows that precede a partition are
    found from one count per (partition, group).
    """
    row_id = "__row_id"
    ordered = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    fixed = cut_lineage(ordered.withColumn(row_id, F.monotonically_increasing_id()))

    part = F.shiftright(F.col(row_id), 33).alias("__part")
    blocks = fixed.groupBy(part, *group).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(row_id).alias("__first")
    )
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "__part",
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        "__first",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
    )
    same_block = F.shiftright(F.col(row_id), 33) == F.col("__part")
    for i, g in enumerate(group):
        same_block &= F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return fixed.join(offsets, same_block, "inner").select(
        *[F.col(c) for c in df.columns],
        (F.col(row_id) - F.col("__first") + F.col("__offset") + 1).alias(position),
    )


def render_lines(df: DataFrame, group: Sequence[str], order: str, line: Column, separator: str, out: str) -> DataFrame:
    """Lines of each group joined in order. The caller bounds the group size."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
    return df.groupBy(*group).agg(
        F.array_join(F.transform(entries, lambda e: e["line"]), separator).alias(out)
    )
