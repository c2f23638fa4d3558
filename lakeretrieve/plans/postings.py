"""Inverted index: ``(term, id, pos)`` rows, and searches on it.

Building needs no shuffle but the one that lays the table out: rows go to term
buckets, and a frequent term is spread over ``salts`` files of its bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeretrieve.functions.text import DEFAULT_ANALYZER, match_mode, tokenize
from lakeretrieve.plans.lookup import shipped
from lakeretrieve.plans.spread import input_bytes, spread
from lakeretrieve.plans.topk import top_per_group
from lakeretrieve.session import materialise

BUCKETS = 64
SALTS = 16
# Bytes of the indexed tables whose postings one task lays out.
TASK_BYTES = 8 << 20
# Distinct query words up to this number become a filter of the index scan.
FEW_TERMS = 100


def term_bucket(term: str = "term", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _layout_tasks(df: DataFrame) -> int:
    """Tasks for the postings of the tables below a plan; 0 if their size is unknown."""
    size = input_bytes(df)
    return 0 if size >= df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes() else -(-size // TASK_BYTES)


def _by_id(rows: DataFrame) -> DataFrame:
    tasks = _layout_tasks(rows)
    number = [max(tasks, rows.sparkSession.sparkContext.defaultParallelism)] if tasks else []
    return rows.repartition(*number, "id")


def build_postings(
    corpus: DataFrame, analyzer: str = DEFAULT_ANALYZER, text: str = "content", *, by_id: bool = False
) -> DataFrame:
    """``(term, id, pos)`` of every token of every document.

    For counts of each id, ``by_id`` brings the texts of an id into one task before they are analysed. Then no
    posting is shuffled, and a task holds the ids and terms of about ``TASK_BYTES`` of the tables at any size.
    """
    rows = corpus.select("id", text)
    rows = _by_id(rows) if by_id else spread(rows)
    return rows.select(F.posexplode(tokenize(F.col(text), analyzer)).alias("pos", "term"), "id").select(
        "term", "id", "pos"
    )


def write_postings(
    postings: DataFrame, path: str, mode: str = "overwrite", buckets: int = BUCKETS, salts: int = SALTS
) -> None:
    """Store postings by term bucket; salts keep a hot term out of one task.

    Rows are sorted by term inside a file, so that a search for a few terms
    skips most row groups of the buckets it opens. A table too large for
    ``buckets x salts`` tasks has more salts; rows of unknown size keep theirs.
    """
    tasks, conf = _layout_tasks(postings), postings.sparkSession._jsparkSession.sessionState().conf()
    salts = max(salts, -(-tasks // buckets))
    number = [tasks] if tasks > conf.numShufflePartitions() else []
    (
        postings.withColumn("bucket", term_bucket("term", buckets))
        .repartition(*number, "bucket", F.pmod(F.xxhash64("id"), F.lit(salts)))
        .sortWithinPartitions("bucket", "term", "id", "pos")
        .write.mode(mode)
        .partitionBy("bucket")
        .parquet(path)
    )


def query_terms(queries: DataFrame, analyzer: str = DEFAULT_ANALYZER) -> DataFrame:
    """``(qid, n_terms, qpos, term)`` for each token of each query text."""
    return queries.select("qid", tokenize(F.col("query"), analyzer).alias("tokens")).select(
        "qid", F.size("tokens").alias("n_terms"), F.posexplode("tokens").alias("qpos", "term")
    )


def _pruned(postings: DataFrame, terms: DataFrame, buckets: int | None) -> DataFrame:
    """Stored postings cut to the buckets, and few terms, that are asked for.

    At most ``buckets`` numbers or ``FEW_TERMS`` words reach the driver; they
    become partition and row-group filters of the scan.
    """
    if buckets is None or "bucket" not in postings.columns:
        return postings
    asked = terms.select(term_bucket("term", buckets).alias("b")).distinct().collect()
    postings = postings.filter(F.col("bucket").isin([row.b for row in asked]))
    words = terms.select("term").distinct().limit(FEW_TERMS + 1).collect()
    if len(words) <= FEW_TERMS:
        postings = postings.filter(F.col("term").isin([row.term for row in words]))
    return postings


def _any_match(postings: DataFrame, terms: DataFrame, n: int, k: int | None) -> DataFrame:
    wanted = terms.select("qid", "term").distinct()
    vocabulary = shipped(wanted.select("term").distinct(), n)
    rows = postings.select("term", "id").join(vocabulary, "term", "left_semi")
    if "pos" in postings.columns:
        rows = rows.distinct()
    if k is not None:
        # The k smallest ids of a query are among the k smallest of its terms.
        rows = top_per_group(rows, ["term"], [F.col("id")], k).drop("rank")
    return rows.join(shipped(wanted, n), "term").select("qid", "id").distinct()


def _all_match(postings: DataFrame, terms: DataFrame, n: int, phrase: bool) -> DataFrame:
    """Documents with every term, found from the rarest term of each query.

    Only places of the rarest term are candidates. The other terms are then
    looked up by (term, id) or, in a phrase, by (term, id, pos): join keys
    without heavy values, whatever the frequency of a term. The lookups are
    written first, so that their size decides how the join is done.
    """
    vocabulary = shipped(terms.select("term").distinct(), n)
    frequency = (
        postings.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))
    )
    if not phrase:
        terms = terms.groupBy("qid", "term").agg(F.min("qpos").alias("qpos"))
    anchors = (
        terms.join(shipped(frequency, n), "term", "left")
        .groupBy("qid")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.count("frequency").alias("n_known"),
            F.min(F.struct("frequency", "qpos", "term")).alias("rarest"),
        )
        # A term that no document holds leaves the query without a match.
        .filter(F.col("n_terms") == F.col("n_known"))
        .select("qid", "n_terms", F.col("rarest.term").alias("term"), F.col("rarest.qpos").alias("anchor"))
    )
    at_anchor = postings.join(shipped(anchors, n), "term")
    if phrase:
        place = ["qid", "id", "start"]
        candidates = at_anchor.select("qid", "id", "n_terms", "anchor", (F.col("pos") - F.col("anchor")).alias("start")).distinct()
    else:
        place = ["qid", "id"]
        candidates = at_anchor.select("qid", "id", "n_terms", "anchor").distinct()
    # One row per term of a candidate; the anchor's own row needs no lookup.
    lookups = materialise(candidates.join(shipped(terms.select("qid", "qpos", "term"), n), "qid"), "lookups")
    single = lookups.filter(F.col("n_terms") == 1).select("qid", "id")
    others = lookups.filter(F.col("qpos") != F.col("anchor"))
    if phrase:
        found = others.withColumn("pos", F.col("start") + F.col("qpos")).join(postings, ["term", "id", "pos"])
    else:
        found = others.join(postings.select("term", "id"), ["term", "id"]).select(
            "qid", "id", "qpos", "n_terms"
        ).distinct()
    complete = (
        found.groupBy(*place)
        # Positions of the query, not rows: an id may be stored more than once.
        .agg(F.count_distinct("qpos").alias("hits"), F.max("n_terms").alias("n_terms"))
        .filter(F.col("hits") == F.col("n_terms") - 1)
    )
    return complete.select("qid", "id").unionByName(single).distinct()


def query_vocabulary(
    corpus: DataFrame, queries: DataFrame, mode: str, analyzer: str = DEFAULT_ANALYZER
) -> DataFrame:
    """Postings of the query terms only, for a search without a stored index.

    The corpus is read and analysed once. Match-any needs one row per term and
    document. The other modes read the positions three times, so those are
    written.
    """
    terms = query_terms(queries, analyzer)
    wanted = shipped(terms.select("term").distinct(), terms.count())
    if match_mode(mode) == "any":
        tokens = F.array_distinct(tokenize(F.col("content"), analyzer))
        rows = spread(corpus.select("id", "content")).select(F.explode(tokens).alias("term"), "id")
        return rows.join(wanted, "term", "left_semi")
    rows = build_postings(corpus, analyzer).join(wanted, "term", "left_semi")
    return materialise(rows, "vocabulary")


def search_postings(
    postings: DataFrame,
    queries: DataFrame,
    k: int | None = 4,
    mode: str = "phrase",
    analyzer: str = DEFAULT_ANALYZER,
    *,
    buckets: int | None = None,
) -> DataFrame:
    """``(qid, rank, id, score)`` for ``queries (qid, query)``; all if k is None.

    Matching has no relevance order: every hit scores 1.0, ids ascend. Give
    the number of ``buckets`` of a stored index to prune its folders.
    """
    terms = query_terms(queries, analyzer)
    n = terms.count()
    kind = match_mode(mode)
    postings = _pruned(postings, terms, buckets)
    if kind == "any":
        hits = _any_match(postings, terms, n, k)
    else:
        hits = _all_match(postings.select("term", "id", "pos"), terms, n, kind == "phrase")
    if k is None:
        return hits.select("qid", "id", F.lit(1.0).alias("score"))
    ranked = top_per_group(hits, ["qid"], [F.col("id")], k)
    return ranked.select("qid", "rank", "id", F.lit(1.0).alias("score"))
