"""Queries that answer from documents and SQL results."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from lakeretrieve.functions import prompts as P
from lakeretrieve.operators import rag as op
from lakeretrieve.operators.vector import knn_batch, with_payload
from lakeretrieve.registry.base import CORPUS_SQL, Tables, query

K = 3

_CONTEXT_SQL = f"""WITH {CORPUS_SQL},
  d AS (SELECT a.id AS qid, b.id, b.content, b.source, greatest(0, list_cosine_distance(a.embedding, b.embedding)) AS distance
        FROM corpus a, corpus b),
  near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 12), id) AS rank FROM d)
           WHERE rank <= {K}),
  ctx AS (SELECT qid, count(*) AS n, string_agg('Document ' || rank || ' (Score: ' || printf('%.3f', 1 - distance / 2)
            || ', Source: ' || source || '):' || chr(10) || content || chr(10), chr(10) ORDER BY rank) AS context
          FROM near GROUP BY qid),
  asked AS (SELECT c.id AS qid, coalesce(context, '{P.NO_DOCUMENTS}') AS context, coalesce(n, 0) AS n_documents, c.content AS question
            FROM corpus c LEFT JOIN ctx ON ctx.qid = c.id)"""


def _questions(t: Tables):
    return t.corpus.select(F.col("id").alias("qid"), F.col("content").alias("question"))


def _contexts(t: Tables):
    corpus = t.corpus
    queries = t.vector_queries.join(corpus.select(F.col("id").alias("qid")), "qid", "left_semi")
    hits = knn_batch(corpus, queries, K)
    rows = with_payload(hits, corpus, queries.count() * K, ["content", "metadata"])
    sourced = rows.withColumn("source", F.get_json_object("metadata", "$.source"))
    return op.context(_questions(t), sourced)


@query("r01_context", _CONTEXT_SQL + " SELECT qid, md5(context) AS context_md5, n_documents FROM asked")
def context(t: Tables):
    return _contexts(t).select("qid", F.md5("context").alias("context_md5"), "n_documents")


@F.pandas_udf(T.StringType())
def _echo(prompts: pd.Series) -> pd.Series:
    """Stands in for a model: the length of the prompt."""
    return prompts.str.len().astype(str) + " characters"


def _sql_results(t: Tables):
    return t.read("labels").select(
        F.col("doc_id").alias("qid"), F.concat(F.lit("quality\n-------\n"), F.col("quality").cast("string")).alias("sql_result")
    )


def _answers(t: Tables):
    return op.answer(_questions(t), _contexts(t), _sql_results(t), _echo)


_ANSWER_SQL = (
    _CONTEXT_SQL
    + """,
  keyed AS (SELECT a.*, l.quality IS NOT NULL AND ("""
    + " OR ".join(f"contains(lower(question), '{k}')" for k in P.SQL_KEYWORDS)
    + """) AS sql_executed, 'quality' || chr(10) || '-------' || chr(10) || l.quality AS sql_result
    FROM asked a LEFT JOIN labels l ON l.doc_id = a.qid),
  shown AS (SELECT *, CASE WHEN sql_executed THEN sql_result ELSE '"""
    + P.NO_SQL
    + "' END AS shown FROM keyed),\n  answered AS (SELECT qid, question, n_documents, sql_executed, ("
    + str(len(P.ANSWER_PROMPT) - len("{context}{sql_result}{question}"))
    + " + length(context) + length(shown) + length(question)) || ' characters' AS answer FROM shown)"
)


@query("r02_answer", _ANSWER_SQL + " SELECT qid, answer, n_documents, sql_executed FROM answered")
def answer(t: Tables):
    return _answers(t).select("qid", "answer", "n_documents", "sql_executed")


@query(
    "r03_ask_in_session",
    _ANSWER_SQL
    + """ SELECT 'user' || label AS session_id, 2 * qid AS seq, 'human' AS type, md5(question) AS content_md5
            FROM answered JOIN embeddings ON vec_id = qid
          UNION ALL SELECT 'user' || label, 2 * qid + 1, 'ai', md5(answer) FROM answered JOIN embeddings ON vec_id = qid""",
)
def ask(t: Tables):
    people = t.vectors.select(F.col("id").alias("qid"), F.concat(F.lit("user"), F.col("label").cast("string")).alias("session_id"))
    asked = _answers(t).join(people, "qid").withColumns(
        {"turn": F.col("qid"), "ts": F.lit("2024-01-01 00:00:00").cast("timestamp")}
    )
    return op.logged_turns(asked).select("session_id", "seq", "type", F.md5("content").alias("content_md5"))
