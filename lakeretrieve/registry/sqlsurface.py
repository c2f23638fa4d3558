"""Queries of the SQL surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window, functions as F, types as T

from lakeretrieve.functions import prompts as P
from lakeretrieve.operators import sqlsurface as op
from lakeretrieve.plans.changelog import apply_upsert
from lakeretrieve.registry.base import TABLE_NAMES, Tables, query, stamp
from lakeretrieve.session import scratch_path
from lakeretrieve.sources.tables import read_months, write_by_month


@query(
    "q01_execute",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, count(*) AS amount
       FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-09-02' AND l_discount >= 0.03 GROUP BY ALL""",
)
def execute(t: Tables):
    """Named parameters; of the two columns called amount the last stays."""
    return op.execute(
        t.views("lineitem"),
        """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, max(l_tax) AS amount, count(*) AS amount
           FROM lineitem WHERE l_shipdate <= CAST(:cutoff AS TIMESTAMP) AND l_discount >= :low
           GROUP BY l_returnflag, l_linestatus""",
        {"cutoff": "1999-09-02", "low": 0.03},
    )


@query(
    "q02_execute_positional",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F'",
)
def execute_positional(t: Tables):
    return op.execute(
        t.views("orders"),
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > ? AND o_orderstatus = ?",
        [400000, "F"],
    )


@query(
    "q03_list_tables",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLE_NAMES),
)
def list_tables(t: Tables):
    """The given tables as the catalog lists them, each with its row count."""
    spark = t.views(*TABLE_NAMES)
    given = op.usable_tables(spark).filter(F.col("table_name").isin(TABLE_NAMES))
    counts = None
    for name in TABLE_NAMES:
        n = spark.table(name).agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        counts = n if counts is None else counts.unionByName(n)
    return given.join(counts, "table_name")


_INFO = {
    "customer": ["c_custkey bigint NULL", "c_name string NULL", "c_nationkey int NULL", "c_acctbal double NULL", "c_mktsegment string NULL"],
    "nation": ["n_nationkey int NULL", "n_name string NULL", "n_regionkey int NULL"],
}
_INFO_TEXT = "\n\n".join("\n".join([f"Table: {name}"] + [f"  {c}" for c in columns]) for name, columns in _INFO.items())


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "q04_describe_tables",
    f"SELECT item_id AS qid, md5({_literal(_INFO_TEXT)}) AS info_md5, md5(text) AS question_md5 FROM benchmark",
)
def describe(t: Tables):
    """Table description beside every question that will be prompted with it."""
    info = op.describe_tables(t.views("customer", "nation"), ["customer", "missing_table", "nation"]).first()[0]
    return t.read("benchmark").select(
        F.col("item_id").alias("qid"), F.md5(F.lit(info)).alias("info_md5"), F.md5("text").alias("question_md5")
    )


@query(
    "q05_render_groups",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
       SELECT c_nationkey, 'c_custkey | c_name | c_mktsegment' || chr(10) || repeat('-', 33) || chr(10) ||
         string_agg(c_custkey || ' | ' || c_name || ' | ' || c_mktsegment, chr(10) ORDER BY rank) AS table_text
       FROM r WHERE rank <= 5 GROUP BY c_nationkey""",
)
def render_groups(t: Tables):
    order = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    top = t.read("customer").withColumn("rank", F.row_number().over(order)).filter("rank <= 5")
    return op.render_groups(top, ["c_nationkey"], "rank", ["c_custkey", "c_name", "c_mktsegment"])


@query(
    "q06_render_top",
    """SELECT 'o_custkey | n' || chr(10) || '-------------' || chr(10) ||
         string_agg(o_custkey || ' | ' || n, chr(10) ORDER BY n DESC, o_custkey) AS table_text
       FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10)""",
)
def render_top(t: Tables):
    result = op.execute(
        t.views("orders"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey"
    )
    return op.render_top(result)


_RESPONSE = "'Let me think.' || chr(10) || 'SQLQuery: \"SELECT ' || doc_id || ' FROM t'' ' || chr(10) || 'SQLResult: ' || text"


def _responses(t: Tables):
    d = F.col("doc_id").cast("string")
    return t.read("documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Let me think.\nSQLQuery: \"SELECT "), d, F.lit(" FROM t' \nSQLResult: "), F.col("text")).alias("response"),
        F.concat(F.lit("SQLQuery: ```sql\nSELECT '"), d, F.lit("'\n```")).alias("fenced"),
    )


@query(
    "q07_extract_sql",
    f"""SELECT doc_id AS id,
          trim(trim(trim(trim(trim(split_part(split_part({_RESPONSE}, 'SQLQuery:', 2), 'SQLResult:', 1), ' ' || chr(10)), '"'), ''''), '`')) AS sql_query,
          'sql' || chr(10) || 'SELECT ''' || doc_id || '''' AS fenced_reference,
          'SELECT ''' || doc_id || '''' AS fenced_paired
        FROM documents""",
)
def extract(t: Tables):
    return _responses(t).select(
        "id",
        P.extract_sql(F.col("response"), "reference").alias("sql_query"),
        P.extract_sql(F.col("fenced"), "reference").alias("fenced_reference"),
        P.extract_sql(F.col("fenced"), "paired").alias("fenced_paired"),
    )


_PROMPT_SQL = _literal(P.SQL_PROMPT)
_RESULT_SQL = _literal(P.RESULT_PROMPT)


@query(
    "q08_prompts",
    f"""SELECT item_id AS qid,
          replace(replace(replace(replace({_PROMPT_SQL}, '{{dialect}}', 'Spark SQL'), '{{table_info}}', 'Table: t'), '{{top_k}}', '5'), '{{input}}', text) AS sql_prompt,
          replace(replace(replace({_RESULT_SQL}, '{{question}}', text), '{{sql_query}}', 'SELECT 1'), '{{result}}', item_id::VARCHAR) AS result_prompt
        FROM benchmark""",
)
def prompts(t: Tables):
    return t.read("benchmark").select(
        F.col("item_id").alias("qid"),
        P.sql_prompt(F.col("text"), "Table: t", top_k=5).alias("sql_prompt"),
        P.result_prompt(F.col("text"), F.lit("SELECT 1"), F.col("item_id")).alias("result_prompt"),
    )


@F.pandas_udf(T.StringType())
def _canned_sql(prompts: pd.Series) -> pd.Series:
    """Stands in for a model: a statement per question, none for one of them."""
    nation = prompts.str.extract(r"Question: How many customers has NATION_(\d+)\?", expand=False)
    sql = "SQLQuery: SELECT count(*) AS n FROM customer WHERE c_nationkey = " + nation
    sql = sql.mask(nation == "7", "SQLQuery: SELECT nothing FROM no_such_table")
    return sql.mask(nation == "3", None)


@F.pandas_udf(T.StringType())
def _canned_answer(prompts: pd.Series) -> pd.Series:
    number = prompts.str.extract(r"\n-\n(\d+)\n", expand=False)
    return "There are " + number


def _questions(t: Tables):
    return t.read("nation").select(
        F.col("n_nationkey").alias("qid"), F.concat(F.lit("How many customers has "), "n_name", F.lit("?")).alias("question")
    )


@query(
    "q09_answer_batch",
    """SELECT n_nationkey AS qid,
         CASE n_nationkey WHEN 3 THEN 'Error generating SQL query: no response'
           WHEN 7 THEN 'Error executing SQL query' ELSE 'There are ' || count(c_custkey) END AS result,
         CASE n_nationkey WHEN 3 THEN 0 WHEN 7 THEN 2 ELSE 3 END AS steps
       FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
def answers(t: Tables):
    spark = t.views("customer")
    rows = op.answer_batch(spark, _questions(t), _canned_sql, _canned_answer)
    # The text after the fixed part of an error depends on the engine.
    shown = F.regexp_extract("result", "^(Error executing SQL query|.*)", 1)
    return rows.select("qid", shown.alias("result"), F.size("intermediate_steps").alias("steps"))


_NEEDS_SQL = "(" + " OR ".join(f"contains(lower({{c}}), '{k}')" for k in P.SQL_KEYWORDS) + ")"


@query(
    "q10_route_question",
    f"SELECT page_id AS id, {_NEEDS_SQL.format(c='html')} AS needs_sql FROM pages "
    f"UNION ALL SELECT -1 - doc_id, {_NEEDS_SQL.format(c='text')} FROM documents",
)
def route(t: Tables):
    pages = t.read("pages").select(F.col("page_id").alias("id"), P.needs_sql(F.col("html")).alias("needs_sql"))
    docs = t.read("documents").select((F.lit(-1) - F.col("doc_id")).alias("id"), P.needs_sql(F.col("text")).alias("needs_sql"))
    return pages.unionByName(docs)


# Statements the SQL surface passes through unchanged: one text for both.
_PASSED = {
    "p01_literals": (
        ["orders"],
        """SELECT 1 AS one, 'ok' AS status, CURRENT_TIMESTAMP IS NOT NULL AS has_clock, count(*) AS n FROM orders""",
    ),
    "p02_top_n": (
        ["orders"],
        """SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey
           ORDER BY spend DESC, o_custkey LIMIT 5""",
    ),
    "p03_filter": (
        ["customer"],
        """SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 5000 AND c_mktsegment = 'BUILDING' AND c_nationkey > 10""",
    ),
    "p04_count": (["lineitem"], "SELECT count(*) AS n FROM lineitem"),
    "p05_count_distinct": (
        ["events"],
        "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
    ),
    "p06_group_aggregate": (
        ["customer"],
        """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS balance FROM customer
           GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment""",
    ),
    "p07_distinct": (["part"], "SELECT DISTINCT p_brand, p_type FROM part ORDER BY p_brand, p_type"),
    "p08_buckets": (
        ["orders"],
        """SELECT CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS bucket,
             CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, count(*) AS n, round(sum(o_totalprice), 2) AS price
           FROM orders GROUP BY 1, 2, 3""",
    ),
    "p09_last_day": (
        ["events"],
        """SELECT event_id, event_type FROM events
           WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
    ),
    "p10_predicates": (
        ["part"],
        """SELECT p_partkey, p_name FROM part
           WHERE p_size IN (3, 7, 11) AND p_name LIKE 'red%' AND p_type = 'ECONOMY'""",
    ),
    "p11_joins": (
        ["customer", "orders", "lineitem", "part"],
        """SELECT p_brand, c_mktsegment, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
           FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
             JOIN part ON p_partkey = l_partkey
           WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
           GROUP BY p_brand, c_mktsegment""",
    ),
}


def _register_passed(name: str, tables: list[str], sql: str) -> None:
    @query(name, sql)
    def run(t: Tables):
        return op.execute(t.views(*tables), sql)


for _name, (_tables, _sql) in _PASSED.items():
    _register_passed(_name, _tables, _sql)


@query(
    "p12_merge",
    """WITH b AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey)
       SELECT c_custkey AS key, coalesce(price, c_acctbal) AS balance, price IS NOT NULL AS updated
       FROM customer LEFT JOIN b ON o_custkey = c_custkey""",
)
def merge(t: Tables):
    start = F.lit("1990-01-01 00:00:00").cast("timestamp")
    target = t.read("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), start.alias("created_at"), start.alias("updated_at")
    )
    source = t.read("orders").select(
        F.col("o_custkey").alias("key"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("ord"),
    )
    merged = apply_upsert(target, source, ["key"], ["balance"])
    return merged.select("key", "balance", (F.col("updated_at") > F.col("created_at")).alias("updated"))


@query(
    "p13_month_partitions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-06-01'""",
)
def months(t: Tables):
    path = scratch_path(t.spark, "months")
    write_by_month(t.read("orders"), path, "o_orderdate")
    return read_months(t.spark, path, "199703", "199705").select("o_orderkey", stamp("o_orderdate").alias("ordered"))
