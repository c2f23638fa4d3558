"""The expressions as SQL functions of the session.

They are SQL-bodied functions, so Catalyst inlines them into the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakeretrieve.functions.text import ENGLISH_STOP_WORDS

_STOP = ", ".join(f"'{word}'" for word in ENGLISH_STOP_WORDS)
_DOT = "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)"
_NORM = "sqrt(aggregate(transform({v}, x -> x * x), 0D, (s, x) -> s + x))"
_TOKENS = r"regexp_extract_all(lower(t), '(\\p{IsHan}|[\\p{L}\\p{N}&&[^\\p{IsHan}]]+)', 1)"
_RUNS = r"regexp_extract_all(lower(t), '(\\p{IsHan}+|[\\p{L}\\p{N}&&[^\\p{IsHan}]]+)', 1)"
_BIGRAMS = (
    f"flatten(transform({_RUNS}, r -> CASE WHEN r RLIKE '^\\\\p{{IsHan}}{{2,}}$' "
    "THEN transform(sequence(1, greatest(length(r) - 1, 1)), i -> substring(r, i, 2)) ELSE array(r) END))"
)

FUNCTIONS = {
    "cosine_distance": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>",
        "DOUBLE",
        f"abs(1D - try_divide({_DOT}, {_NORM.format(v='a')} * {_NORM.format(v='b')}))",
    ),
    "l2_distance": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>",
        "DOUBLE",
        "sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x))",
    ),
    "l1_distance": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>",
        "DOUBLE",
        "aggregate(zip_with(a, b, (x, y) -> abs(x - y)), 0D, (s, x) -> s + x)",
    ),
    "tokenize": (
        "t STRING, options MAP<STRING, STRING>",
        "ARRAY<STRING>",
        "CASE coalesce(lower(options['analyzer']), 'unicode') "
        "WHEN 'keyword' THEN filter(array(t), x -> length(x) > 0) "
        f"WHEN 'english' THEN filter({_TOKENS}, x -> x NOT IN ({_STOP})) "
        f"WHEN 'chinese' THEN {_BIGRAMS} WHEN 'ik' THEN {_BIGRAMS} "
        f"ELSE {_TOKENS} END",
    ),
    "match_phrase": (
        "t STRING, q STRING, options MAP<STRING, STRING>",
        "BOOLEAN",
        "size(tokenize(q, options)) > 0 AND contains("
        "concat('\\u0001', array_join(tokenize(t, options), '\\u0001'), '\\u0001'), "
        "concat('\\u0001', array_join(tokenize(q, options), '\\u0001'), '\\u0001'))",
    ),
    "match_all": (
        "t STRING, q STRING, options MAP<STRING, STRING>",
        "BOOLEAN",
        "size(tokenize(q, options)) > 0 AND size(array_except(tokenize(q, options), tokenize(t, options))) = 0",
    ),
    "match_any": (
        "t STRING, q STRING, options MAP<STRING, STRING>",
        "BOOLEAN",
        "size(tokenize(q, options)) > 0 AND arrays_overlap(tokenize(t, options), tokenize(q, options))",
    ),
}


def register(spark: SparkSession) -> None:
    """Create the functions in the session, replacing older ones."""
    for name, (arguments, returns, body) in FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}"
        )
