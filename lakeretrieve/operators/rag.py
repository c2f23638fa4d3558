"""Answers from retrieved documents and SQL results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lakeretrieve.functions import prompts as P
from lakeretrieve.operators.chat import save_turns
from lakeretrieve.plans.topk import render_lines


def context(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """``(qid, context, n_documents)`` for each question.

    ``hits`` has ``qid, rank, score, source, content``, at most k rows a
    question. A question without hits gets the fixed sentence.
    """
    block = P.document_block(F.col("rank"), F.col("score"), F.col("source"), F.col("content"))
    texts = render_lines(hits, ["qid"], "rank", block, "\n", "context")
    counts = hits.groupBy("qid").agg(F.count(F.lit(1)).alias("n_documents"))
    return (
        questions.select("qid")
        .join(texts.join(counts, "qid"), "qid", "left")
        .select(
            "qid",
            F.coalesce("context", F.lit(P.NO_DOCUMENTS)).alias("context"),
            F.coalesce("n_documents", F.lit(0)).alias("n_documents"),
        )
    )


def answer(
    questions: DataFrame, contexts: DataFrame, sql_results: DataFrame, model: Callable[[Column], Column]
) -> DataFrame:
    """``(qid, question, answer, n_documents, sql_executed)``.

    ``sql_results (qid, sql_result)`` is used for questions that ask for data;
    ``model`` is a column function over the prompt.
    """
    joined = questions.join(contexts, "qid", "left").join(sql_results, "qid", "left")
    asked = P.needs_sql(F.col("question")) & F.col("sql_result").isNotNull()
    shown = F.when(asked, F.col("sql_result")).otherwise(F.lit(P.NO_SQL))
    prompt = P.answer_prompt(F.col("question"), F.coalesce("context", F.lit(P.NO_DOCUMENTS)), shown)
    return joined.select(
        "qid",
        "question",
        model(prompt).alias("answer"),
        F.coalesce("n_documents", F.lit(0)).alias("n_documents"),
        asked.alias("sql_executed"),
    )


def logged_turns(asked: DataFrame) -> DataFrame:
    """Chat messages of answered questions ``session_id, turn, ts, question, answer``."""
    return save_turns(
        asked.select(
            "session_id", "turn", "ts", F.col("question").alias("input"), F.col("answer").alias("output")
        )
    )
