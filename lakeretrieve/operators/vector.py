"""Vector search, re-ranking, ingest and deletion.

A corpus has ``id, content, metadata, embedding`` (only ``id`` and
``embedding`` are needed for ranking); queries have ``qid, qvector``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.metadata import metadata_filter, metadata_text
from lakeretrieve.plans import neighbours
from lakeretrieve.plans.lookup import fetch_rows

DEFAULT_K = 4
DEFAULT_FETCH_K = 20
# Fixed value: the dimension assumed when no vector can tell.
DEFAULT_DIMENSION = 1536


def _filtered(corpus: DataFrame, conditions: dict | None) -> DataFrame:
    if not conditions:
        return corpus
    return corpus.filter(metadata_filter(F.col("metadata"), conditions))


def knn(
    corpus: DataFrame,
    query_vector: Sequence[float],
    k: int = DEFAULT_K,
    metric: str = "cosine",
    *,
    conditions: dict | None = None,
    below: float | None = None,
    with_score: bool = True,
) -> DataFrame:
    """k rows nearest to one vector: scan, filter, per-task top-k, one merge."""
    numbers = [float(x) for x in query_vector]
    query = F.array(*[F.lit(x) for x in numbers])
    if V.metric_kind(metric) == "cosine":
        away = V.cosine_distance(F.col("embedding"), query, math.sqrt(sum(x * x for x in numbers)))
        # Cosine ties are decided at 12 decimals, as in the batch form.
        away = F.round(away, 12)
    else:
        away = V.distance(metric, F.col("embedding"), query)
    measured = _filtered(corpus, conditions).withColumn("distance", away)
    # Undefined distances sort last, so they and the threshold are tested on
    # the k rows that remain instead of measuring every row twice.
    nearest = measured.orderBy(F.asc_nulls_last("distance"), F.col("id")).limit(k)
    nearest = nearest.filter(F.col("distance").isNotNull() & ~F.isnan("distance"))
    if below is not None:
        nearest = nearest.filter(F.col("distance") < below)
    if not with_score:
        return nearest.drop("distance")
    return nearest.withColumn("score", V.score(metric, F.col("distance")))


def knn_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    metric: str = "cosine",
    *,
    conditions: dict | None = None,
    below: float | None = None,
    **layout,
) -> DataFrame:
    """``(qid, rank, id, distance, score)`` for a table of query vectors."""
    rows = _filtered(corpus, conditions).select("id", F.col("embedding").alias("vector"))
    found = neighbours.nearest(rows, queries, k, metric, below=below, **layout)
    return found.withColumn("score", V.score(metric, F.col("distance")))


def with_payload(
    hits: DataFrame, corpus: DataFrame, most_rows: int, columns: Sequence[str] = ("content", "metadata")
) -> DataFrame:
    """Hits with corpus columns; ``most_rows`` is a bound such as queries x k."""
    return fetch_rows(hits, corpus, columns, most_rows)


def _mmr_picks(query: np.ndarray, vectors: np.ndarray, k: int, trade_off: float) -> list[int]:
    """Order of at most k picks; candidate 0 is always the first."""
    if len(vectors) <= k:
        return list(range(len(vectors)))

    def unit(m: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(m, axis=-1, keepdims=True)
        return m / np.where(length == 0.0, 1.0, length)

    items = unit(vectors)
    relevance = items @ unit(query)
    overlap = np.zeros(len(items))
    picks = [0]
    open_ = np.ones(len(items), dtype=bool)
    open_[0] = False
    while len(picks) < k:
        overlap = np.maximum(overlap, items @ items[picks[-1]])
        gain = np.round(trade_off * relevance - (1.0 - trade_off) * overlap, 12)
        gain[~open_] = -np.inf
        pick = int(np.argmax(gain))
        picks.append(pick)
        open_[pick] = False
    return picks


def mmr_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    fetch_k: int = DEFAULT_FETCH_K,
    trade_off: float = 0.5,
    metric: str = "cosine",
    *,
    conditions: dict | None = None,
    hits: DataFrame | None = None,
    **layout,
) -> DataFrame:
    """``(qid, rank, id, distance)``: k diverse rows out of the fetch_k nearest.

    ``hits`` are the fetch_k nearest rows if they were found elsewhere, such as in an index.

    A group holds one query's candidates, so it never exceeds ``fetch_k`` rows.
    Similarities are compared at 12 decimals; ties go to the nearer candidate.
    """
    if hits is None:
        hits = knn_batch(corpus, queries, fetch_k, metric, conditions=conditions, **layout)
    candidates = with_payload(hits, corpus, queries.count() * fetch_k, ["embedding"])
    bundles = (
        candidates.groupBy("qid")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("rank", "id", "distance", F.col("embedding").cast("array<double>").alias("v")))
            ).alias("c")
        )
        .join(queries.select("qid", F.col("qvector").cast("array<double>").alias("qvector")), "qid")
        .select("qid", "qvector", F.col("c.id").alias("ids"), F.col("c.distance").alias("d"), F.col("c.v").alias("v"))
    )
    wanted = max(k, 1)
    out = T.StructType(
        [
            hits.schema["qid"],
            T.StructField("rank", T.IntegerType()),
            hits.schema["id"],
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for qid, query, ids, distances, items in batch.itertuples(index=False):
                picks = _mmr_picks(np.asarray(query), np.stack(items), wanted, trade_off)
                rows += [(qid, rank, ids[i], distances[i]) for rank, i in enumerate(picks, 1)]
            yield pd.DataFrame(rows, columns=out.names)

    return bundles.mapInPandas(pick, out)


def embed(df: DataFrame, text: str, embedder: Callable[[Column], Column], out: str = "embedding") -> DataFrame:
    """Text embedded by a column function, such as a user's iterator pandas UDF."""
    return df.withColumn(out, embedder(F.col(text)))


def content_id(content: Column) -> Column:
    """MD5 of the content: the same text always has the same id."""
    return F.md5(content.cast("binary"))


def prepare_texts(
    texts: DataFrame,
    embedder: Callable[[Column], Column] | None = None,
    *,
    ids: str = "content",
    element: str = "float",
) -> DataFrame:
    """Rows ready to append: ids, metadata text and (with an embedder) vectors.

    ``texts`` has ``content`` and optionally ``id`` and ``metadata``. A missing
    id is the content hash, so that a repeated job writes the same rows, or a
    random UUID with ``ids="uuid"``. Nothing is deduplicated.
    """
    fresh = F.uuid() if ids == "uuid" else content_id(F.col("content"))
    given = F.col("id").cast("string") if "id" in texts.columns else F.lit(None).cast("string")
    metadata = F.col("metadata") if "metadata" in texts.columns else F.lit(None).cast("string")
    rows = texts.select(
        F.coalesce(given, fresh).alias("id"), "content", metadata_text(metadata).alias("metadata")
    )
    if embedder is None:
        return rows
    return embed(rows, "content", lambda c: embedder(c).cast(f"array<{V.ELEMENT_TYPES.get(element, 'float')}>"))


def delete_ids(table: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of a table whose id is not listed."""
    return table.join(ids.select(id_col), id_col, "left_anti")


def dimension(corpus: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row with the common vector length; mixed lengths fail the job."""
    low, high = F.min(F.size(vector)), F.max(F.size(vector))
    checked = F.when(low == high, high).otherwise(
        F.when(low.isNull(), F.lit(DEFAULT_DIMENSION)).otherwise(
            F.raise_error(F.lit("vectors have different lengths")).cast("int")
        )
    )
    return corpus.filter(F.col(vector).isNotNull()).agg(checked.alias("dimension"))

