"""SQL surface: execution, catalog text, rendered results, answer batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.functions import prompts as P
from lakeretrieve.plans.topk import render_lines
from lakeretrieve.session import scratch_path

DEFAULT_TOP_K = 10
# Statements per Spark job of an answer batch.
STATEMENTS_PER_JOB = 32


def execute(spark: SparkSession, query: str, params: dict | Sequence | None = None) -> DataFrame:
    """Result of a statement with named or positional parameters.

    Of duplicate column names the last one stays.
    """
    result = spark.sql(query, args=params) if params else spark.sql(query)
    names = result.columns
    if len(set(names)) == len(names):
        return result
    unique = result.toDF(*[f"__c{i}" for i in range(len(names))])
    last = {name: i for i, name in enumerate(names)}
    return unique.select(*[F.col(f"__c{last[name]}").alias(name) for name in dict.fromkeys(names)])


def records(result: DataFrame, limit: int) -> tuple[list[dict], list[str]]:
    """At most ``limit`` rows as dictionaries, and the column names."""
    return [row.asDict() for row in result.limit(limit).collect()], result.columns


def usable_tables(spark: SparkSession, database: str | None = None, *, base_only: bool = False) -> DataFrame:
    """Sorted table names of a database; ``[]`` becomes an empty table."""
    try:
        found = spark.catalog.listTables(database)
    except PySparkException:
        found = []
    names = sorted(t.name for t in found if not (base_only and t.isTemporary))
    return spark.createDataFrame([(n,) for n in names], "table_name string").orderBy("table_name")


def table_columns(spark: SparkSession, tables: Sequence[str] | None = None, database: str | None = None) -> DataFrame:
    """``(table_name, ordinal, column_name, data_type, nullable, comment)``."""
    if not tables:
        tables = [row[0] for row in usable_tables(spark, database).collect()]
    rows = []
    for place, table in enumerate(tables):
        name = table if database is None or "." in table else f"{database}.{table}"
        try:
            columns = spark.catalog.listColumns(name)
        except PySparkException:
            continue
        rows += [
            (place, table, i, c.name, c.dataType, bool(c.nullable), c.description or "")
            for i, c in enumerate(columns)
        ]
    return spark.createDataFrame(
        rows,
        "place int, table_name string, ordinal int, column_name string, data_type string, nullable boolean, comment string",
    )


def describe_tables(spark: SparkSession, tables: Sequence[str] | None = None, database: str | None = None) -> DataFrame:
    """One row: the text that describes the tables to a reader or a model.

    Missing tables are skipped. A column comment takes the place of a default.
    """
    line = F.concat(
        F.lit("  "),
        "column_name",
        F.lit(" "),
        "data_type",
        F.when(F.col("nullable"), F.lit(" NULL")).otherwise(F.lit(" NOT NULL")),
        F.when(F.col("comment") != "", F.concat(F.lit(" DEFAULT "), "comment")).otherwise(F.lit("")),
    )
    blocks = render_lines(
        table_columns(spark, tables, database), ["place", "table_name"], "ordinal", line, "\n", "lines"
    ).withColumn("block", F.concat(F.lit("Table: "), "table_name", F.lit("\n"), "lines"))
    return blocks.agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "block"))), lambda b: b["block"]), "\n\n"
        ).alias("table_info")
    )


def row_line(columns: Sequence[str]) -> Column:
    """Values of a row joined by bars; null reads as None."""
    return F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])


def _with_header(body: Column, columns: Sequence[str]) -> Column:
    header = " | ".join(columns)
    return F.concat(F.lit(header + "\n" + "-" * len(header) + "\n"), body)


def render_groups(df: DataFrame, group: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Rows of each group as a text table. The caller bounds the group size
    (a top-k per group), as the text is read by a person or a model."""
    body = render_lines(df, group, order, row_line(columns), "\n", "body")
    return body.select(*group, _with_header(F.col("body"), columns).alias("table_text"))


def render_top(df: DataFrame, top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """One row with the first ``top_k`` rows as text; the limit is in the plan."""
    columns = df.columns
    lines = df.limit(top_k).select(F.monotonically_increasing_id().alias("o"), row_line(columns).alias("line"))
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda e: e["line"]), "\n"
    )
    return lines.agg(F.count(F.lit(1)).alias("n"), joined.alias("body")).select(
        F.when(F.col("n") == 0, F.lit(P.NO_RESULTS)).otherwise(_with_header(F.col("body"), columns)).alias("table_text")
    )


def run_text(spark: SparkSession, query: str, limit: int | None = None) -> str:
    """Rows of a statement as text, all of them or ``limit`` at most; errors become text."""
    try:
        result = execute(spark, query)
        shown = result if limit is None else result.limit(limit)
        lines = [row[0] for row in shown.select(row_line(result.columns)).collect()]
    except PySparkException as e:
        return f"Error executing query: {e}"
    if not lines:
        return ""
    header = " | ".join(result.columns)
    return "\n".join([header, "-" * len(header), *lines])


def _error(message: str) -> str:
    return f"Error executing SQL query: {message}"


def run_statements(spark: SparkSession, statements: DataFrame, top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """``(sql_query, sql_result)`` for every distinct statement.

    A statement can only be submitted from the driver. Distinct statements are
    streamed to it, planned in groups and run as one job per group; results go
    to a table in the shared folder. A failing statement gives its error text.
    """
    path = scratch_path(spark, "statements")
    distinct = statements.select("sql_query").filter(F.col("sql_query").isNotNull()).distinct()

    def rendered(sql: str) -> DataFrame:
        try:
            return render_top(execute(spark, sql), top_k).select(
                F.lit(sql).alias("sql_query"), F.col("table_text").alias("sql_result")
            )
        except PySparkException as e:
            return failed(sql, e)

    def failed(sql: str, e: Exception) -> DataFrame:
        message = str(e).split("\n", 1)[0]
        return spark.createDataFrame([(sql, _error(message))], "sql_query string, sql_result string")

    def flush(group: list[str]) -> None:
        try:
            reduce(DataFrame.unionByName, map(rendered, group)).coalesce(1).write.mode("append").parquet(path)
        except Exception:
            # One statement failed while running: find it, keep the others.
            for sql in group:
                try:
                    rendered(sql).coalesce(1).write.mode("append").parquet(path)
                except Exception as e:
                    failed(sql, e).coalesce(1).write.mode("append").parquet(path)

    group: list[str] = []
    for row in distinct.toLocalIterator():
        group.append(row[0])
        if len(group) == STATEMENTS_PER_JOB:
            flush(group)
            group = []
    if group:
        flush(group)
    spark.createDataFrame([], "sql_query string, sql_result string").write.mode("append").parquet(path)
    return spark.read.schema("sql_query string, sql_result string").parquet(path)


def answer_batch(
    spark: SparkSession,
    questions: DataFrame,
    generate: Callable[[Column], Column],
    format_answer: Callable[[Column], Column],
    *,
    table_info: str = "",
    top_k: int = DEFAULT_TOP_K,
    dialect: str = "Spark SQL",
    extraction: str = "paired",
) -> DataFrame:
    """``(qid, result, sql_query, intermediate_steps)`` for ``(qid, question)``.

    ``generate`` and ``format_answer`` are column functions, as a rule pandas
    UDFs around a model, that take a prompt column. A null response counts as
    a failed call: generation then gives an error text as the result, and a
    failed answer falls back to the raw SQL result.
    """
    response = generate(P.sql_prompt(F.col("question"), table_info, dialect, top_k))
    path = scratch_path(spark, "generated")
    # A model call is costly and may differ when repeated: written once.
    questions.select("qid", "question", response.alias("response")).select(
        "qid", "question", P.extract_sql(F.col("response"), extraction).alias("sql_query")
    ).write.parquet(path)
    generated = spark.read.schema("qid {}, question string, sql_query string".format(
        questions.schema["qid"].dataType.simpleString()
    )).parquet(path)

    results = run_statements(spark, generated, top_k)
    executed = generated.join(results, "sql_query", "left")
    answered = executed.withColumn(
        "answer",
        F.when(
            F.col("sql_query").isNotNull(),
            format_answer(P.result_prompt(F.col("question"), F.col("sql_query"), F.col("sql_result"))),
        ),
    )
    final = (
        F.when(F.col("sql_query").isNull(), F.lit("Error generating SQL query: no response"))
        .when(F.col("answer").isNull(), F.col("sql_result"))
        .otherwise(F.trim("answer"))
    )

    def step(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("step"), value.alias("value"))

    steps = F.filter(
        F.array(
            step("sql_generation", F.col("sql_query")),
            step("sql_execution", F.col("sql_result")),
            step("result_formatting", F.trim("answer")),
        ),
        lambda s: s["value"].isNotNull(),
    )
    return answered.select("qid", final.alias("result"), "sql_query", steps.alias("intermediate_steps"))
