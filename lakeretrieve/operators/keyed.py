"""Key-value and document stores, set at a time.

A store is ``key, value, created_at, updated_at`` (or ``key, content,
metadata, ...``); requests are tables of keys with an order column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeretrieve.functions.metadata import clean_metadata
from lakeretrieve.plans.changelog import apply_delete, apply_upsert
from lakeretrieve.plans.lookup import shipped
from lakeretrieve.session import materialise


def mget(
    requests: DataFrame,
    store: DataFrame,
    values: Sequence[str] = ("value",),
    *,
    key: str = "key",
    empty_is_null: bool = True,
) -> DataFrame:
    """Requested keys with their values; a missing key has null values.

    ``requests`` has ``ord, key``; duplicates are repeated. In the key-value
    store an empty text reads back as null.
    """
    picked = [
        F.nullif(F.col(v), F.lit("")).alias(v) if empty_is_null else F.col(v) for v in values
    ]
    found = requested_rows(requests, store, key).select(key, *picked)
    return requests.select("ord", key).join(found, key, "left").select("ord", key, *values)


def requested_rows(requests: DataFrame, store: DataFrame, key: str = "key") -> DataFrame:
    """Rows of a store that are asked for, at most once each.

    Requests are counted first: up to the broadcast limit the store is scanned
    without a shuffle, however large it is. Beyond it the join is shuffled, and
    AQE splits a key that is asked for very often.
    """
    wanted = requests.select(key).distinct()
    return store.join(shipped(wanted, requests.count()), key, "left_semi")


def mset(store: DataFrame, pairs: DataFrame, values: Sequence[str] = ("value",), *, key: str = "key") -> DataFrame:
    """Store after an upsert of ``pairs (key, values, ts, ord)``."""
    return apply_upsert(store, pairs, [key], list(values))


def mdelete(store: DataFrame, keys: DataFrame, *, key: str = "key") -> DataFrame:
    return apply_delete(store, keys, [key])


def yield_keys(store: DataFrame, prefix: str | None = None, *, key: str = "key") -> DataFrame:
    """Sorted keys with a literal prefix; no prefix gives all."""
    rows = store.select(key)
    if prefix:
        rows = rows.filter(F.col(key).startswith(prefix))
    return rows.orderBy(key)


def get_documents(requests: DataFrame, store: DataFrame, *, null_metadata_as_empty: bool = False) -> DataFrame:
    """``(ord, key, content, metadata)`` of the documents that are found.

    Unparsable metadata reads as ``{}``. A document without metadata (written
    by plain ``mset``) counts as not found unless told otherwise.
    """
    rows = store if null_metadata_as_empty else store.filter(F.col("metadata").isNotNull())
    rows = requested_rows(requests, rows)
    return requests.select("ord", "key").join(
        rows.select("key", "content", clean_metadata(F.col("metadata")).alias("metadata")), "key", "inner"
    ).select("ord", "key", "content", "metadata")


def compute_missing(
    inputs: DataFrame, cache: DataFrame, compute: Callable[[Column], Column], *, prefix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Cache-aside: ``(results, new cache rows)``.

    ``inputs`` has ``input``; keys are the prefix and the input's MD5. Only
    distinct inputs without a cached value are computed, and that once: the
    new values are written before they are handed out twice.
    """
    keyed = inputs.select("input").distinct().withColumn(
        "key", F.concat(F.lit(prefix), F.md5(F.col("input").cast("binary")))
    )
    missing = keyed.join(cache.select("key"), "key", "left_anti")
    fresh = materialise(missing.select("key", "input", compute(F.col("input")).alias("value")), "computed")
    known = keyed.join(cache.select("key", "value"), "key", "inner").select("key", "input", "value")
    results = known.withColumn("cached", F.lit(True)).unionByName(fresh.withColumn("cached", F.lit(False)))
    return results, fresh.select("key", "value")


def unique_content(documents: DataFrame, content: str = "content") -> DataFrame:
    """Documents with the MD5 of their content as id, one row per id.

    Of identical contents the smallest source row (by all other columns) stays.
    """
    rest = [c for c in documents.columns if c != content]
    hashed = documents.withColumn("id", F.md5(F.col(content).cast("binary")))
    smallest = F.min(F.struct(*rest, content)) if rest else F.min(F.struct(content))
    return hashed.groupBy("id").agg(smallest.alias("d")).select("id", "d.*")


def batch_rows(rows: DataFrame, batch_size: int) -> DataFrame:
    """Rows with a batch number of at most about ``batch_size`` rows.

    Batches are hash slices sized from the row count: no global sort and no
    single task that numbers the rows.
    """
    total = rows.count()
    slices = max(1, -(-total // batch_size))
    return rows.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))


def store_statistics(store: DataFrame, now: Column, ts: str = "created_at") -> DataFrame:
    """Total rows and rows of the last day, in one pass."""
    return store.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(ts) >= now - F.expr("INTERVAL 1 DAY")).alias("added_last_day"),
    )


def session_blobs(sessions: DataFrame, store: DataFrame) -> DataFrame:
    """JSON state of each session under ``session:<id>``, ``{}`` when absent."""
    keyed = sessions.select("session_id", F.concat(F.lit("session:"), F.col("session_id")).alias("key"))
    found = requested_rows(keyed, store.select("key", "value"))
    return keyed.join(found, "key", "left").select(
        "session_id", clean_metadata(F.col("value")).alias("state")
    )

