"""Fusion of vector and full-text hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.metadata import json_text
from lakeretrieve.functions.text import DEFAULT_ANALYZER
from lakeretrieve.operators.fulltext import search_batch
from lakeretrieve.operators.vector import knn_batch
from lakeretrieve.plans.lookup import fetch_rows
from lakeretrieve.plans.topk import top_per_group


def fetch_size(k: int) -> int:
    """Rows taken from each side before fusion."""
    return max(2 * k, 10)


def vector_hits(corpus: DataFrame, queries: DataFrame, k: int = 4, metric: str = "cosine", **options) -> DataFrame:
    """kNN with the hybrid store's score: one minus the distance."""
    return knn_batch(corpus, queries, k, metric, **options).withColumn("score", V.hybrid_score(F.col("distance")))


def _normalised(score: str) -> Column:
    """Score over the largest of the query's fetched rows, if that is positive."""
    top = F.max(score).over(Window.partitionBy("qid"))
    return F.coalesce(F.when(top > 0, F.col(score) / top).otherwise(F.col(score)), F.lit(0.0))


def fuse(
    vector_side: DataFrame,
    text_side: DataFrame,
    k: int = 4,
    alpha: float = 0.5,
    *,
    key: str = "id",
    first: str = "vector",
) -> DataFrame:
    """``(qid, rank, key, hybrid_score, vector_score, fulltext_score)``.

    Both sides are ``qid, rank, <key>, score``. Each score is divided by the
    largest of its side, a missing side counts 0, and
    ``hybrid = (1 - alpha) * text + alpha * vector``. Equal scores keep the
    rows of the side named ``first`` before the others, in that side's order.
    A query has at most two fetches of rows here, so its window is small.
    """
    left = vector_side.select("qid", key, F.col("score").alias("v"), F.col("rank").alias("v_rank"))
    right = text_side.select("qid", key, F.col("score").alias("t"), F.col("rank").alias("t_rank"))
    merged = left.join(right, ["qid", key], "full").select(
        "qid",
        key,
        "v_rank",
        "t_rank",
        _normalised("v").alias("vector_score"),
        _normalised("t").alias("fulltext_score"),
    )
    lead, follow = ("v_rank", "t_rank") if first == "vector" else ("t_rank", "v_rank")
    scored = merged.withColumn(
        "hybrid_score",
        F.round((1.0 - alpha) * F.col("fulltext_score") + alpha * F.col("vector_score"), 12),
    )
    order = [F.desc("hybrid_score"), F.asc_nulls_last(lead), F.asc_nulls_last(follow)]
    ranked = top_per_group(scored, ["qid"], order, k)
    return ranked.select("qid", "rank", key, "hybrid_score", "vector_score", "fulltext_score")


def hybrid_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    alpha: float = 0.5,
    metric: str = "cosine",
    mode: str = "phrase",
    analyzer: str = DEFAULT_ANALYZER,
    *,
    conditions: dict | None = None,
    postings: DataFrame | None = None,
) -> DataFrame:
    """Both searches on one table, fused. Queries: ``qid, query, qvector``.

    A metadata filter is applied before either side takes its rows.
    """
    n = fetch_size(k)
    vectors = vector_hits(corpus, queries, n, metric, conditions=conditions)
    texts = search_batch(
        corpus, queries.select("qid", "query"), n, mode, analyzer, postings=postings, conditions=conditions
    )
    return fuse(vectors, texts, k, alpha)


def fuse_key(mode: str, side: str) -> Column:
    """Key that says when two hits are the same document.

    ``id`` and ``content`` are plain; ``reference`` takes the id on the text
    side and the metadata's ``document_id``, else the content hash, on the
    vector side.
    """
    content = F.sha2(F.col("content").cast("binary"), 256)
    if mode == "id":
        return F.col("id").cast("string")
    if mode == "content":
        return content
    if mode == "reference":
        if side == "text":
            return F.col("id").cast("string")
        return F.coalesce(json_text(F.col("metadata"), "document_id"), content)
    raise ValueError(f"unknown fuse_on: {mode}")


def cross_table_search(
    vector_table: DataFrame,
    text_table: DataFrame,
    queries: DataFrame,
    k: int = 4,
    alpha: float = 0.5,
    metric: str = "cosine",
    mode: str = "phrase",
    *,
    fuse_on: str = "content",
    postings: DataFrame | None = None,
) -> DataFrame:
    """Fusion of a vector table and a full-text table.

    The vector score is the vector store's. Hits of one side that share a key
    keep the last one, as a keyed merge does.
    """
    n = fetch_size(k)
    vectors = knn_batch(vector_table, queries, n, metric)
    texts = search_batch(text_table, queries.select("qid", "query"), n, mode, postings=postings)

    most_rows = queries.count() * n

    def keyed(hits: DataFrame, table: DataFrame, side: str) -> DataFrame:
        # The key is computed on the hits, not on the whole table.
        columns = [c for c in ("content", "metadata") if c in table.columns]
        rows = fetch_rows(hits, table, columns, most_rows).withColumn("fuse_key", fuse_key(fuse_on, side))
        return rows.groupBy("qid", "fuse_key").agg(
            F.max_by("score", "rank").alias("score"),
            F.min("rank").alias("rank"),
            F.max_by("id", "rank").alias(f"{side}_id"),
        )

    left, right = keyed(vectors, vector_table, "vector"), keyed(texts, text_table, "text")
    fused = fuse(left, right, k, alpha, key="fuse_key", first="text")
    # The surviving payload is the later side's: the vector row where present.
    return (
        fused.join(left.select("qid", "fuse_key", "vector_id"), ["qid", "fuse_key"], "left")
        .join(right.select("qid", "fuse_key", "text_id"), ["qid", "fuse_key"], "left")
        .withColumn("id", F.coalesce("vector_id", "text_id"))
        .drop("vector_id", "text_id")
    )


def retrieve(corpus: DataFrame, queries: DataFrame, search_type: str = "hybrid", k: int = 4, **options) -> DataFrame:
    """``(qid, rank, id, score)`` by strategy; an unknown name means hybrid."""
    conditions = options.get("conditions")
    if search_type == "vector":
        return vector_hits(
            corpus, queries, k, options.get("metric", "cosine"), conditions=conditions
        ).select("qid", "rank", "id", "score")
    if search_type == "fulltext":
        return search_batch(
            corpus,
            queries.select("qid", "query"),
            k,
            options.get("mode", "phrase"),
            options.get("analyzer", DEFAULT_ANALYZER),
            conditions=conditions,
        ).select("qid", "rank", "id", "score")
    return hybrid_search(corpus, queries, k, **options).select(
        "qid", "rank", "id", F.col("hybrid_score").alias("score")
    )


def compare_strategies(corpus: DataFrame, queries: DataFrame, k: int = 4, **options) -> DataFrame:
    """The same queries through all three strategies."""
    parts = [
        retrieve(corpus, queries, search_type, k, **options).withColumn("strategy", F.lit(name))
        for name, search_type in (("semantic", "vector"), ("keyword", "fulltext"), ("hybrid", "hybrid"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

