"""Queries on text."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeretrieve.functions import text as X
from lakeretrieve.functions.metadata import clean_metadata, parse_metadata
from lakeretrieve.functions.sqlfuncs import register
from lakeretrieve.operators import fulltext as op
from lakeretrieve.plans import blocks
from lakeretrieve.plans.postings import build_postings, search_postings, write_postings
from lakeretrieve.registry.base import (
    DOC_TOKENS_SQL,
    QUERY_TOKENS_SQL,
    Tables,
    all_sql,
    any_sql,
    phrase_sql,
    query,
)
from lakeretrieve.session import scratch_path

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in X.ENGLISH_STOP_WORDS) + "]"


@query(
    "t01_tokenize",
    f"""WITH {DOC_TOKENS_SQL} SELECT id, len(tokens)::INTEGER AS n, md5(array_to_string(tokens, ' ')) AS tokens_md5
        FROM doc_tokens""",
)
def tokenize(t: Tables):
    register(t.spark)
    t.views("documents")
    return t.spark.sql(
        """SELECT id, size(tokens) AS n, md5(array_join(tokens, ' ')) AS tokens_md5
           FROM (SELECT doc_id AS id, tokenize(text, map('analyzer', 'unicode')) AS tokens FROM documents)"""
    )


@query(
    "t02_analyzers",
    f"""WITH {DOC_TOKENS_SQL},
      e AS (SELECT id, tokens, list_filter(tokens, lambda w: NOT list_contains({STOP_SQL}, w)) AS english FROM doc_tokens)
      SELECT e.id, len(tokens)::INTEGER AS standard, len(english)::INTEGER AS english,
        len(tokens)::INTEGER AS chinese, 1 AS keyword,
        md5(array_to_string(english, ' ')) AS english_md5, md5(d.text) AS keyword_md5
      FROM e JOIN documents d ON d.doc_id = e.id""",
)
def analyzers(t: Tables):
    tokens = {a: X.tokenize(F.col("content"), a) for a in ("standard", "english", "chinese", "keyword")}
    return t.texts.select("id", *[c.alias(a) for a, c in tokens.items()]).select(
        "id",
        *[F.size(a).alias(a) for a in tokens],
        F.md5(F.array_join("english", " ")).alias("english_md5"),
        F.md5(F.array_join("keyword", " ")).alias("keyword_md5"),
    )


def _match_sql(test: str) -> str:
    return f"WITH {DOC_TOKENS_SQL} SELECT id FROM doc_tokens WHERE {test}"


@query("t03_match_phrase", _match_sql(phrase_sql("tokens", "['de', 'la']")))
def phrase(t: Tables):
    return op.matching(t.texts, "De la", "phrase").select("id")


@query("t04_match_all", _match_sql(all_sql("tokens", "['that', 'and', 'with']")))
def match_all(t: Tables):
    register(t.spark)
    t.views("documents")
    return t.spark.sql(
        "SELECT doc_id AS id FROM documents WHERE match_all(text, :q, map('analyzer', 'unicode'))",
        args={"q": "that, and with"},
    )


@query("t05_match_any", _match_sql(any_sql("tokens", "['éai', 'for']")))
def match_any(t: Tables):
    return op.matching(t.texts, "éai for", "any").select("id")


@query(
    "t06_mode_dispatch",
    f"""WITH {DOC_TOKENS_SQL}, q AS (SELECT ['is', 'on', 'it'] AS q)
      SELECT id, {phrase_sql('tokens', 'q')} AS phrase, {all_sql('tokens', 'q')} AS boolean_mode,
        {all_sql('tokens', 'q')} AS all_mode, {any_sql('tokens', 'q')} AS natural_mode,
        {any_sql('tokens', 'q')} AS any_mode, {phrase_sql('tokens', 'q')} AS other
      FROM doc_tokens, q""",
)
def modes(t: Tables):
    names = {
        "phrase": "phrase", "boolean_mode": "boolean", "all_mode": "all",
        "natural_mode": "natural", "any_mode": "any", "other": "fuzzy",
    }
    tokens, asked = F.col("tokens"), X.tokenize(F.lit("is on it"))
    return t.texts.select("id", X.tokenize(F.col("content")).alias("tokens")).select(
        "id", *[X.tokens_match(mode, tokens, asked).alias(c) for c, mode in names.items()]
    )


@query(
    "t07_search",
    f"""WITH {DOC_TOKENS_SQL} SELECT id, d.lang, 1.0::DOUBLE AS score
        FROM doc_tokens JOIN documents d ON d.doc_id = id
        WHERE {phrase_sql('tokens', "['in', 'the']")} ORDER BY id LIMIT 10""",
)
def search(t: Tables):
    return op.search(t.texts, "in the", 10).select("id", F.get_json_object("metadata", "$.lang").alias("lang"), "score")


def _batch_sql(test: str, k: int | None) -> str:
    hits = f"""WITH {DOC_TOKENS_SQL}, {QUERY_TOKENS_SQL},
      hits AS (SELECT qid, id FROM query_tokens, doc_tokens WHERE {test})"""
    if k is None:
        return hits + " SELECT qid, id, 1.0::DOUBLE AS score FROM hits"
    return hits + f""", r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY id)::INTEGER AS rank FROM hits)
      SELECT qid, rank, id, 1.0::DOUBLE AS score FROM r WHERE rank <= {k}"""


def _register_batch(mode: str, test: str) -> None:
    @query(f"t07_search_batch_{mode}", _batch_sql(test, 4))
    def on_the_fly(t: Tables):
        return op.search_batch(t.texts, t.text_queries, 4, mode)

    @query(f"t09_postings_search_{mode}", _batch_sql(test, None))
    def on_postings(t: Tables):
        path = scratch_path(t.spark, "postings")
        write_postings(build_postings(t.texts), path, buckets=8, salts=2)
        return search_postings(t.spark.read.parquet(path), t.text_queries, None, mode, buckets=8)

    @query(f"t09_block_search_{mode}", _batch_sql(test, None))
    def on_blocks(t: Tables):
        return blocks.search_index(_block_index(t), t.text_queries, None, mode)


def _block_index(t: Tables) -> blocks.BlockIndex:
    return blocks.write_index(t.texts, scratch_path(t.spark, "block-index"))


_register_batch("phrase", phrase_sql("tokens", "q"))
_register_batch("all", all_sql("tokens", "q"))
_register_batch("any", any_sql("tokens", "q"))


_POSTINGS_SQL = f"""WITH {DOC_TOKENS_SQL},
  p AS (SELECT id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM doc_tokens)"""


@query(
    "t08_build_postings",
    _POSTINGS_SQL
    + """ SELECT term, id, count(*)::INTEGER AS n, min(pos)::INTEGER AS first_pos, max(pos)::INTEGER AS last_pos,
            sum(pos)::BIGINT AS sum_pos FROM p GROUP BY term, id""",
)
def postings(t: Tables):
    n = F.count(F.lit(1)).cast("int").alias("n")
    first, last = F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    return build_postings(t.texts).groupBy("term", "id").agg(n, first, last, F.sum("pos").alias("sum_pos"))


@query(
    "t08_block_postings",
    _POSTINGS_SQL
    + """ SELECT term, id, count(*)::INTEGER AS n, min(pos)::INTEGER AS first_pos, max(pos)::INTEGER AS last_pos,
            sum(pos)::BIGINT AS sum_pos FROM p GROUP BY term, id""",
)
def block_postings(t: Tables):
    """Every block of a stored index, read back, decoded and counted."""
    return _block_index(t).counts().select("term", "id", F.col("n").cast("int").alias("n"), "first_pos", "last_pos", "sum_pos")


@query(
    "t08_term_statistics",
    _POSTINGS_SQL + " SELECT term, count(DISTINCT id) AS documents, count(*) AS occurrences FROM p GROUP BY term",
)
def term_statistics(t: Tables):
    return _block_index(t).terms


@query(
    "t10_add_and_delete",
    _POSTINGS_SQL
    + """, b AS (SELECT -1 - item_id AS id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark),
      u AS (SELECT id, term FROM p WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
            UNION ALL SELECT id, term FROM b)
      SELECT term, count(DISTINCT id) AS documents, count(*) AS occurrences FROM u GROUP BY term""",
)
def add_and_delete(t: Tables):
    toxic = t.read("labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    new = t.read("benchmark").select(
        (F.lit(-1) - F.col("item_id")).alias("id"), F.col("text").alias("content"), F.lit("{}").alias("metadata")
    )
    kept, index = op.delete_documents(t.texts, build_postings(t.texts), toxic)
    _, index = op.add_documents(kept, index, new)
    return index.groupBy("term").agg(
        F.count_distinct("id").alias("documents"), F.count(F.lit(1)).alias("occurrences")
    )


@query(
    "t11_parse_metadata",
    """SELECT event_id AS id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN NULL
         ELSE json_extract_string(props, '$.k') END AS k,
         CASE WHEN event_type IN ('view', 'click') THEN '{}' ELSE props END AS cleaned FROM events""",
)
def metadata(t: Tables):
    broken = (
        F.when(F.col("event_type") == "view", F.lit(""))
        .when(F.col("event_type") == "click", F.concat(F.col("props"), F.lit("}")))
        .otherwise(F.col("props"))
    )
    rows = t.read("events").select(F.col("event_id").alias("id"), broken.alias("metadata"))
    return rows.select(
        "id",
        F.try_variant_get(parse_metadata(F.col("metadata")), "$.k", "string").alias("k"),
        clean_metadata(F.col("metadata")).alias("cleaned"),
    )
