"""Fetching corpus rows for a set of hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Narrow tables (ids, terms, scores) up to this many rows are shipped to tasks.
BROADCAST_ROWS = 500_000


def shipped(df: DataFrame, most_rows: int) -> DataFrame:
    """Broadcast a table whose proven row bound is within the limit."""
    return F.broadcast(df) if most_rows <= BROADCAST_ROWS else df


def unshipped(df: DataFrame) -> DataFrame:
    """A table that must not be broadcast by the size of its files, which may hold a hundred times as much in memory."""
    return df.hint("merge")


def fetch_rows(hits: DataFrame, table: DataFrame, columns: Sequence[str], most_rows: int) -> DataFrame:
    """Hits with columns of ``table``, joined on ``id``.

    ``most_rows`` is a proven bound on the hits (queries x k). Within the limit
    the hits are broadcast and the table is scanned once without a shuffle;
    beyond it both sides are shuffled on the id.
    """
    return table.select("id", *columns).join(shipped(hits, most_rows), "id", "inner")
