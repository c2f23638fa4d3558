"""Queries that fuse vector and text search."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeretrieve.functions.vectors import hash_embedding
from lakeretrieve.operators import hybrid as op
from lakeretrieve.operators.vector import delete_ids, prepare_texts
from lakeretrieve.plans.postings import build_postings
from lakeretrieve.registry.base import (
    CORPUS_SQL,
    DOC_TOKENS_SQL,
    QUERY_TOKENS_SQL,
    Tables,
    all_sql,
    any_sql,
    phrase_sql,
    query,
    r6,
)

_TESTS = {"all": all_sql, "any": any_sql, "phrase": phrase_sql}


def _sides_sql(n: int, mode: str, score: str, where: str = "TRUE") -> str:
    """Both fetches of every query: ``vs`` and ``ts`` with rank and score."""
    return f"""WITH {CORPUS_SQL}, {DOC_TOKENS_SQL}, {QUERY_TOKENS_SQL},
      hq AS (SELECT qid, q, e.embedding::DOUBLE[] AS qv FROM query_tokens JOIN embeddings e ON e.vec_id = qid),
      kept AS (SELECT corpus.*, tokens FROM corpus JOIN doc_tokens USING (id) WHERE {where}),
      vd AS (SELECT qid, id, content, greatest(0, list_cosine_distance(embedding, qv)) AS distance FROM hq, kept),
      vs AS (SELECT qid, id, content, {score} AS score, rank FROM (
               SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 12), id) AS rank FROM vd)
             WHERE rank <= {n}),
      ts AS (SELECT qid, id, content, 1.0::DOUBLE AS score, rank FROM (
               SELECT qid, id, content, row_number() OVER (PARTITION BY qid ORDER BY id) AS rank
               FROM hq, kept WHERE {_TESTS[mode]('tokens', 'q')})
             WHERE rank <= {n})"""


def _fuse_sql(key: str, k: int, alpha: float, first: str) -> str:
    lead, follow = ("v.rank", "t.rank") if first == "vector" else ("t.rank", "v.rank")
    norm = "CASE WHEN max({s}) OVER w > 0 THEN {s} / max({s}) OVER w ELSE {s} END"
    return f""",
      merged AS (SELECT coalesce(v.qid, t.qid) AS qid, coalesce(v.{key}, t.{key}) AS {key},
                   coalesce(v.id, t.id) AS id, {lead} AS lead, {follow} AS follow, v.score AS vraw, t.score AS traw
                 FROM vs v FULL JOIN ts t ON v.qid = t.qid AND v.{key} = t.{key}),
      normed AS (SELECT *, coalesce({norm.format(s='vraw')}, 0) AS vector_score,
                   coalesce({norm.format(s='traw')}, 0) AS fulltext_score
                 FROM merged WINDOW w AS (PARTITION BY qid)),
      scored AS (SELECT *, round({1 - alpha} * fulltext_score + {alpha} * vector_score, 12) AS hybrid_score FROM normed),
      fused AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY hybrid_score DESC,
                  lead NULLS LAST, follow NULLS LAST)::INTEGER AS rank FROM scored)"""


_OUT_SQL = """ SELECT qid, rank, id, round(hybrid_score, 6) AS hybrid_score, round(vector_score, 6) AS vector_score,
      round(fulltext_score, 6) AS fulltext_score FROM fused WHERE rank <= {k}"""


def _shown(hits, key="id"):
    return hits.select(
        "qid", "rank", key, *[r6(c).alias(c) for c in ("hybrid_score", "vector_score", "fulltext_score")]
    )


@query(
    "h01_hybrid_ingest",
    r"""SELECT md5(text) AS id, count(DISTINCT term) AS terms, 16 AS dim
        FROM (SELECT text, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents) GROUP BY text""",
)
def ingest(t: Tables):
    # One id per content: the postings of equal documents are the same rows.
    rows = prepare_texts(t.texts.select("content", "metadata"), lambda c: hash_embedding(c, 16))
    rows = rows.dropDuplicates(["id"])
    terms = build_postings(rows, by_id=True).groupBy("id").agg(F.count_distinct("term").alias("terms"))
    return rows.join(terms, "id").select("id", "terms", F.size("embedding").alias("dim"))


@query(
    "h02_vector_hits",
    _sides_sql(10, "any", "1 - distance")
    + " SELECT qid, rank::INTEGER AS rank, id, round(score, 6) AS score, round(1 - score, 6) AS distance FROM vs",
)
def vector_hits(t: Tables):
    hits = op.vector_hits(t.corpus, t.hybrid_queries, 10)
    return hits.select("qid", "rank", "id", r6("score").alias("score"), r6("distance").alias("distance"))


def _register_fusion(mode: str, alpha: float) -> None:
    sql = _sides_sql(10, mode, "1 - distance") + _fuse_sql("id", 4, alpha, "vector") + _OUT_SQL.format(k=4)

    @query(f"h03_hybrid_{mode}", sql)
    def run(t: Tables):
        return _shown(op.hybrid_search(t.corpus, t.hybrid_queries, 4, alpha, mode=mode))


_register_fusion("all", 0.5)
_register_fusion("any", 0.3)
_register_fusion("phrase", 0.7)


@query(
    "h04_cross_table_id",
    _sides_sql(10, "any", "greatest(0, 1 - distance / 2)") + _fuse_sql("id", 5, 0.5, "text") + _OUT_SQL.format(k=5),
)
def cross_table(t: Tables):
    hits = op.cross_table_search(t.corpus, t.corpus, t.hybrid_queries, 5, 0.5, mode="any", fuse_on="id")
    return _shown(hits)


_KEYED_SQL = """,
  vs1 AS (SELECT qid, sha256(content) AS fuse_key, arg_max(score, rank) AS score, min(rank) AS rank, arg_max(id, rank) AS id
          FROM vs GROUP BY ALL),
  ts1 AS (SELECT qid, sha256(content) AS fuse_key, arg_max(score, rank) AS score, min(rank) AS rank, arg_max(id, rank) AS id
          FROM ts GROUP BY ALL)"""


@query(
    "h04_cross_table_content",
    _sides_sql(10, "any", "greatest(0, 1 - distance / 2)")
    + _KEYED_SQL
    + _fuse_sql("fuse_key", 5, 0.5, "text").replace("FROM vs v FULL JOIN ts t", "FROM vs1 v FULL JOIN ts1 t")
    + _OUT_SQL.format(k=5),
)
def cross_table_content(t: Tables):
    return _shown(op.cross_table_search(t.corpus, t.corpus, t.hybrid_queries, 5, 0.5, mode="any"))


@query(
    "h06_search_type",
    _sides_sql(10, "all", "1 - distance")
    + _fuse_sql("id", 4, 0.5, "vector")
    + """ SELECT 'other' AS search_type, qid, rank, id, round(hybrid_score, 6) AS score FROM fused WHERE rank <= 4
      UNION ALL SELECT 'vector', qid, rank::INTEGER, id, round(score, 6) FROM vs WHERE rank <= 4
      UNION ALL SELECT 'fulltext', qid, rank::INTEGER, id, score FROM ts WHERE rank <= 4""",
)
def search_type(t: Tables):
    parts = [
        op.retrieve(t.corpus, t.hybrid_queries, name, 4, mode="all").select(
            F.lit(name).alias("search_type"), "qid", "rank", "id", r6("score").alias("score")
        )
        for name in ("vector", "fulltext", "other")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "h07_delete_from_hybrid",
    f"""WITH {CORPUS_SQL}, {DOC_TOKENS_SQL},
      kept AS (SELECT id FROM corpus WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
      p AS (SELECT id, count(DISTINCT term) AS terms FROM (SELECT id, unnest(tokens) AS term FROM doc_tokens) GROUP BY id)
      SELECT id, terms FROM kept JOIN p USING (id)""",
)
def delete(t: Tables):
    toxic = t.read("labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    rows = delete_ids(t.corpus.select("id", "content"), toxic)
    index = delete_ids(build_postings(t.corpus.select("id", "content"), by_id=True), toxic)
    return rows.select("id").join(index.groupBy("id").agg(F.count_distinct("term").alias("terms")), "id")


@query(
    "h08_hybrid_with_filter",
    _sides_sql(10, "any", "1 - distance", "lang = 'en' AND label = 3")
    + _fuse_sql("id", 4, 0.5, "vector")
    + _OUT_SQL.format(k=4),
)
def filtered(t: Tables):
    return _shown(
        op.hybrid_search(t.corpus, t.hybrid_queries, 4, 0.5, mode="any", conditions={"lang": "en", "label": 3})
    )


@query(
    "h09_compare_strategies",
    _sides_sql(10, "all", "1 - distance")
    + _fuse_sql("id", 4, 0.5, "vector")
    + """ SELECT 'hybrid' AS strategy, qid, rank, id, round(hybrid_score, 6) AS score FROM fused WHERE rank <= 4
      UNION ALL SELECT 'semantic', qid, rank::INTEGER, id, round(score, 6) FROM vs WHERE rank <= 4
      UNION ALL SELECT 'keyword', qid, rank::INTEGER, id, score FROM ts WHERE rank <= 4""",
)
def compare(t: Tables):
    rows = op.compare_strategies(t.corpus, t.hybrid_queries, 4, mode="all")
    return rows.select("strategy", "qid", "rank", "id", r6("score").alias("score"))
