"""Expressions for the question-to-answer chain: prompts, extraction, routing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SQL_PROMPT = (
    "You write {dialect} queries. Use only the tables described here.\n"
    "{table_info}\n"
    "Return at most {top_k} rows unless the question says otherwise.\n"
    "Answer with the line 'SQLQuery:' followed by the statement.\n"
    "Question: {input}\n"
    "SQLQuery:"
)

RESULT_PROMPT = (
    "Question: {question}\n"
    "SQL statement: {sql_query}\n"
    "SQL result:\n{result}\n"
    "Answer the question from this result in one short paragraph.\n"
    "Answer:"
)

ANSWER_PROMPT = (
    "Context documents:\n{context}\n"
    "SQL result:\n{sql_result}\n"
    "Question: {question}\n"
    "Answer from the context and the SQL result; say so if they do not suffice.\n"
    "Answer:"
)

# Words that send a question to the SQL chain.
SQL_KEYWORDS = [
    "count", "how many", "total", "sum", "average", "maximum", "minimum",
    "users", "orders", "sales", "revenue", "data", "records", "table",
]

# Sentences given when a stage has nothing to show.
NO_RESULTS = "No results found."
NO_DOCUMENTS = "No relevant documents found."
NO_SQL = "No SQL query attempted."
UNKNOWN_SOURCE = "Unknown"

QUERY_MARKER = "SQLQuery:"
RESULT_MARKER = "SQLResult:"


def fill(template: str, values: dict[str, Column]) -> Column:
    """Template with its placeholders replaced, each value inserted once.

    The template is cut at the placeholders first, so a value that happens to
    contain ``{question}`` is left as it is.
    """
    pieces: list[Column] = []
    rest = template
    while rest:
        found = sorted((rest.find("{" + name + "}"), name) for name in values if "{" + name + "}" in rest)
        if not found:
            pieces.append(F.lit(rest))
            break
        start, name = found[0]
        if start:
            pieces.append(F.lit(rest[:start]))
        pieces.append(F.coalesce(values[name].cast("string"), F.lit("")))
        rest = rest[start + len(name) + 2:]
    return F.concat(*pieces)


def sql_prompt(question: Column, table_info: Column | str, dialect: str = "Spark SQL", top_k: int = 10) -> Column:
    info = F.lit(table_info) if isinstance(table_info, str) else table_info
    return fill(
        SQL_PROMPT,
        {"dialect": F.lit(dialect), "table_info": info, "top_k": F.lit(top_k), "input": question},
    )


def result_prompt(question: Column, sql_query: Column, result: Column) -> Column:
    return fill(RESULT_PROMPT, {"question": question, "sql_query": sql_query, "result": result})


def answer_prompt(question: Column, context: Column, sql_result: Column) -> Column:
    return fill(ANSWER_PROMPT, {"context": context, "sql_result": sql_result, "question": question})


def extract_sql(response: Column, mode: str = "paired") -> Column:
    """SQL statement inside a model response.

    Text after the first query marker and before the result marker. Mode
    ``reference`` strips double quotes, single quotes, backticks and spaces
    from both ends in that order, whether paired or not; ``paired`` (default)
    removes code fences and only quotes that enclose the whole statement.
    """
    if mode not in ("paired", "reference"):
        raise ValueError("mode must be 'paired' or 'reference'")
    marked = F.split_part(
        F.split_part(response, F.lit(QUERY_MARKER), F.lit(2)), F.lit(RESULT_MARKER), F.lit(1)
    )
    text = F.when(F.instr(response, QUERY_MARKER) > 0, _strip(marked, r"\s")).otherwise(response)
    if mode == "reference":
        for char in ('"', "'", "`"):
            text = _strip(text, char)
        return _strip(text, r"\s")
    text = _strip(text, r"\s")
    text = F.regexp_replace(text, r"(?s)^```(?:\w+)?\s*\n?(.*?)\s*```$", "$1")
    for char in ('"', "'", "`"):
        text = F.regexp_replace(text, f"(?s)^{char}([^{char}]*){char}$", "$1")
    return _strip(text, r"\s")


def _strip(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, f"^(?:{chars})+|(?:{chars})+$", "")


def needs_sql(question: Column) -> Column:
    """Whether a question contains one of the data keywords."""
    lowered = F.lower(question)
    return F.exists(F.array(*[F.lit(k) for k in SQL_KEYWORDS]), lambda k: F.contains(lowered, k))


def document_block(position: Column, score: Column, source: Column, content: Column) -> Column:
    """One context document with its header line."""
    return F.concat(
        F.lit("Document "),
        position.cast("string"),
        F.lit(" (Score: "),
        F.format_string("%.3f", F.coalesce(score, F.lit(0.0))),
        F.lit(", Source: "),
        F.coalesce(source, F.lit(UNKNOWN_SOURCE)),
        F.lit("):\n"),
        F.coalesce(content, F.lit("")),
        F.lit("\n"),
    )
