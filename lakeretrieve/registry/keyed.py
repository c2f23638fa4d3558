"""Queries on key-value and document stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeretrieve.operators import keyed as op
from lakeretrieve.plans.changelog import ChangeLog
from lakeretrieve.registry.base import Tables, query, stamp
from lakeretrieve.session import scratch_path

_START = "TIMESTAMP '2024-01-01 00:00:00'"

_STORE_SQL = f"""store AS (
  SELECT 'customer:' || c_custkey || ':profile' AS key,
         c_name || '|' || c_nationkey || '|' || c_mktsegment AS value,
         {_START} AS created_at, {_START} AS updated_at FROM customer)"""

_CHANGES_SQL = f"""changes AS (
  SELECT 'customer:' || o_custkey || ':profile' AS key, o_orderstatus || '|' || o_orderpriority AS value,
         o_orderdate AS ts, o_orderkey AS ord FROM orders
  UNION ALL
  SELECT 'supplier:' || s_suppkey || ':profile', s_name, {_START}, s_suppkey FROM supplier)"""

_BATCH_SQL = "batch AS (SELECT key, arg_max(value, ord) AS value, arg_max(ts, ord) AS ts FROM changes GROUP BY key)"


def _start():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix + ":"), F.col(column).cast("string"), F.lit(":profile"))


def _store(t: Tables):
    return t.read("customer").select(
        _key("customer", "c_custkey").alias("key"),
        F.concat_ws("|", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("value"),
        _start().alias("created_at"),
        _start().alias("updated_at"),
    )


def _changes(t: Tables):
    updates = t.read("orders").select(
        _key("customer", "o_custkey").alias("key"),
        F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("ord"),
    )
    inserts = t.read("supplier").select(
        _key("supplier", "s_suppkey").alias("key"),
        F.col("s_name").alias("value"),
        _start().alias("ts"),
        F.col("s_suppkey").alias("ord"),
    )
    return updates.unionByName(inserts)


@query(
    "k01_mget",
    f"""WITH {_STORE_SQL}, {_CHANGES_SQL}
      SELECT c.ord, c.key, s.value FROM changes c LEFT JOIN store s USING (key)""",
)
def mget(t: Tables):
    return op.mget(_changes(t).select("ord", "key"), _store(t))


@query(
    "k02_mset",
    f"""WITH {_STORE_SQL}, {_CHANGES_SQL}, {_BATCH_SQL}
      SELECT key, coalesce(b.value, s.value) AS value,
        strftime(coalesce(s.created_at, b.ts), '%Y-%m-%d %H:%M:%S') AS created_at,
        strftime(coalesce(b.ts, s.updated_at), '%Y-%m-%d %H:%M:%S') AS updated_at
      FROM store s FULL JOIN batch b USING (key)""",
)
def mset(t: Tables):
    merged = op.mset(_store(t), _changes(t))
    return merged.select("key", "value", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at"))


@query(
    "k02_change_log",
    f"""WITH {_STORE_SQL}, {_CHANGES_SQL}, {_BATCH_SQL},
      gone AS (SELECT DISTINCT 'customer:' || o_custkey || ':profile' AS key FROM orders WHERE o_orderpriority = '1-URGENT')
      SELECT b.key, b.value,
        strftime(CASE WHEN g.key IS NOT NULL THEN c.first_ts ELSE coalesce(s.created_at, c.first_ts) END, '%Y-%m-%d %H:%M:%S') AS created_at,
        strftime(b.ts, '%Y-%m-%d %H:%M:%S') AS updated_at
      FROM batch b LEFT JOIN store s USING (key) LEFT JOIN gone g USING (key)
        JOIN (SELECT key, arg_min(ts, ord) AS first_ts FROM changes GROUP BY key) c USING (key)
      UNION ALL
      SELECT s.key, s.value, strftime(s.created_at, '%Y-%m-%d %H:%M:%S'), strftime(s.updated_at, '%Y-%m-%d %H:%M:%S')
      FROM store s WHERE key NOT IN (SELECT key FROM batch) AND key NOT IN (SELECT key FROM gone)""",
)
def change_log(t: Tables):
    """Put all customers, delete some, then put all changes; read the live rows."""
    log = ChangeLog(t.spark, scratch_path(t.spark, "log"), {"key": "string"}, {"value": "string"})
    log.put(_store(t), ts=F.col("created_at"))
    urgent = t.read("orders").filter("o_orderpriority = '1-URGENT'")
    log.delete(urgent.select(_key("customer", "o_custkey").alias("key")), ts=_start())
    log.put(_changes(t), order="ord", ts=F.col("ts"))
    return log.current().select(
        "key", "value", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at")
    )


@query(
    "k03_mdelete",
    f"""WITH {_STORE_SQL} SELECT key, value FROM store WHERE key NOT IN
      (SELECT 'customer:' || o_custkey || ':profile' FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def mdelete(t: Tables):
    urgent = t.read("orders").filter("o_orderpriority = '1-URGENT'").select(_key("customer", "o_custkey").alias("key"))
    return op.mdelete(_store(t), urgent).select("key", "value")


@query("k04_yield_keys", f"WITH {_STORE_SQL} SELECT key FROM store WHERE starts_with(key, 'customer:1') ORDER BY key")
def yield_keys(t: Tables):
    return op.yield_keys(_store(t), "customer:1")


_DOCS_SQL = """docs AS (
  SELECT 'doc:' || doc_id AS key, text AS content,
    CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN '{broken' ELSE '{"lang":"' || lang || '","source":"' || source || '"}' END AS metadata
  FROM documents)"""


def _docs(t: Tables):
    metadata = (
        F.when(F.col("lang") == "fr", F.lit(None).cast("string"))
        .when(F.col("lang") == "de", F.lit("{broken"))
        .otherwise(F.to_json(F.struct("lang", "source")))
    )
    return t.read("documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("key"),
        F.col("text").alias("content"),
        metadata.alias("metadata"),
        _start().alias("created_at"),
        _start().alias("updated_at"),
    )


@query(
    "k05_store_documents",
    f"""WITH {_DOCS_SQL},
      c AS (SELECT 'doc:' || doc_id AS key, 'quality ' || quality AS content, '{{"toxic":' || toxic || '}}' AS metadata FROM labels)
      SELECT key, md5(CASE WHEN c.key IS NULL THEN d.content ELSE c.content END) AS content_md5,
        CASE WHEN c.key IS NULL THEN d.metadata ELSE c.metadata END AS metadata,
        c.key IS NOT NULL AS changed
      FROM (SELECT key, content, metadata FROM docs) d LEFT JOIN c USING (key)""",
)
def store_documents(t: Tables):
    changes = t.read("labels").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("key"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("content"),
        F.to_json(F.struct("toxic")).alias("metadata"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("ts"),
        F.col("doc_id").alias("ord"),
    )
    merged = op.mset(_docs(t), changes, ["content", "metadata"])
    return merged.select(
        "key", F.md5("content").alias("content_md5"), "metadata", (F.col("updated_at") > F.col("created_at")).alias("changed")
    )


@query(
    "k06_get_documents",
    f"""WITH {_DOCS_SQL}
      SELECT l.doc_id AS ord, d.key, md5(d.content) AS content_md5,
        CASE WHEN d.metadata = '{{broken' THEN '{{}}' ELSE d.metadata END AS metadata
      FROM labels l JOIN docs d ON d.key = 'doc:' || l.doc_id WHERE d.metadata IS NOT NULL""",
)
def get_documents(t: Tables):
    requests = t.read("labels").select(
        F.col("doc_id").alias("ord"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("key")
    )
    found = op.get_documents(requests, _docs(t))
    return found.select("ord", "key", F.md5("content").alias("content_md5"), "metadata")


@query(
    "k07_document_values",
    f"""WITH {_DOCS_SQL},
      c AS (SELECT 'doc:' || doc_id AS key, text AS content FROM documents UNION ALL
            SELECT 'bench:' || item_id, text FROM benchmark)
      SELECT c.key, md5(c.content) AS content_md5, d.metadata FROM c LEFT JOIN docs d USING (key)""",
)
def document_values(t: Tables):
    """Plain mset on documents: new documents have no metadata."""
    new = t.read("benchmark").select(
        F.concat(F.lit("bench:"), F.col("item_id").cast("string")).alias("key"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("metadata"),
        _start().alias("ts"),
        F.col("item_id").alias("ord"),
    )
    merged = op.mset(_docs(t), new, ["content", "metadata"])
    return merged.select("key", F.md5("content").alias("content_md5"), "metadata")


@query(
    "k08_compute_missing",
    """SELECT 'len:' || md5(d.text) AS key, length(d.text)::VARCHAR AS value,
         d.text IN (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS cached
       FROM (SELECT DISTINCT text FROM documents) d""",
)
def compute_missing(t: Tables):
    labelled = t.read("labels").select(F.col("doc_id").alias("id"))
    cached = t.texts.join(labelled, "id", "left_semi").select("content").distinct()
    cache = cached.select(
        F.concat(F.lit("len:"), F.md5("content")).alias("key"), F.length("content").cast("string").alias("value")
    )
    inputs = t.texts.select(F.col("content").alias("input"))
    results, _ = op.compute_missing(inputs, cache, lambda c: F.length(c).cast("string"), prefix="len:")
    return results.select("key", "value", "cached")


@query("k09_content_ids", "SELECT md5(text) AS id, min(doc_id) AS doc_id FROM documents GROUP BY text")
def content_ids(t: Tables):
    return op.unique_content(t.read("documents").select("doc_id", "text"), "text").select("id", "doc_id")


@query("k10_batched_ingest", "SELECT count(*) AS rows, count(DISTINCT doc_id) AS ids FROM documents")
def batched(t: Tables):
    return op.batch_rows(t.texts, 100).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")
    ).agg(F.sum("n").alias("rows"), F.sum("ids").alias("ids"))


@query(
    "k11_store_statistics",
    """SELECT count(*) AS total,
         count(*) FILTER (WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY) AS added_last_day FROM events""",
)
def statistics(t: Tables):
    events = t.read("events").select("ts")
    now = events.agg(F.max("ts")).first()[0]
    return op.store_statistics(events, F.lit(now), "ts")


@query(
    "k12_session_blobs",
    """WITH s AS (SELECT 'session:' || conv_id AS key, max(turn) AS turns, count(*) FILTER (WHERE role = 'user') AS asked
                  FROM conversations GROUP BY conv_id)
      SELECT doc_id::VARCHAR AS session_id,
        coalesce('{"turns":' || turns || ',"asked":' || asked || '}', '{}') AS state
      FROM labels LEFT JOIN s ON s.key = 'session:' || doc_id""",
)
def session_blobs(t: Tables):
    states = t.read("conversations").groupBy("conv_id").agg(
        F.max("turn").alias("turns"), F.count_if(F.col("role") == "user").alias("asked")
    )
    store = states.select(
        F.concat(F.lit("session:"), F.col("conv_id").cast("string")).alias("key"),
        F.to_json(F.struct("turns", "asked")).alias("value"),
    )
    return op.session_blobs(t.sessions, store)
