"""Full-text search over a corpus ``id, content, metadata``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeretrieve.functions.metadata import metadata_filter
from lakeretrieve.functions.text import DEFAULT_ANALYZER, match
from lakeretrieve.plans.postings import build_postings, query_vocabulary, search_postings


def matching(corpus: DataFrame, query: str, mode: str = "phrase", analyzer: str = DEFAULT_ANALYZER) -> DataFrame:
    """Rows whose content matches one query: a scan with a filter."""
    return corpus.filter(match(mode, F.col("content"), query, analyzer))


def search(
    corpus: DataFrame,
    query: str,
    k: int = 4,
    mode: str = "phrase",
    analyzer: str = DEFAULT_ANALYZER,
    *,
    conditions: dict | None = None,
) -> DataFrame:
    """The k matching rows with the smallest ids, all with score 1.0."""
    if conditions:
        corpus = corpus.filter(metadata_filter(F.col("metadata"), conditions))
    return matching(corpus, query, mode, analyzer).orderBy("id").limit(k).withColumn("score", F.lit(1.0))


def search_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int | None = 4,
    mode: str = "phrase",
    analyzer: str = DEFAULT_ANALYZER,
    *,
    postings: DataFrame | None = None,
    buckets: int | None = None,
    conditions: dict | None = None,
) -> DataFrame:
    """``(qid, rank, id, score)`` for a table of query texts.

    Without stored postings the corpus is analysed on the fly and cut to the
    query vocabulary before any shuffle.
    """
    if conditions:
        corpus = corpus.filter(metadata_filter(F.col("metadata"), conditions))
        if postings is not None:
            postings = postings.join(corpus.select("id"), "id", "left_semi")
    if postings is None:
        postings = query_vocabulary(corpus, queries, mode, analyzer)
    return search_postings(postings, queries, k, mode, analyzer, buckets=buckets)


def delete_documents(corpus: DataFrame, postings: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corpus and postings without the listed ids."""
    return corpus.join(ids, "id", "left_anti"), postings.join(ids, "id", "left_anti")


def add_documents(
    corpus: DataFrame, postings: DataFrame, documents: DataFrame, analyzer: str = DEFAULT_ANALYZER
) -> tuple[DataFrame, DataFrame]:
    """Corpus and postings with new rows appended; only those are analysed."""
    return (
        corpus.unionByName(documents.select(*corpus.columns)),
        postings.unionByName(build_postings(documents, analyzer).select(*postings.columns)),
    )
