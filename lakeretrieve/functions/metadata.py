"""Expressions on the JSON metadata string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EMPTY_JSON = "{}"


def metadata_text(metadata: Column) -> Column:
    """Stored form: null becomes an empty object."""
    return F.coalesce(metadata, F.lit(EMPTY_JSON))


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value; null and empty text are not.

    The parsers stop after the first value and accept whatever follows it, so
    the text is tested inside an array and inside an object: a stray closing
    sign of either kind breaks one of the two.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1
    return F.coalesce(in_array & in_object, F.lit(False))


def parse_metadata(metadata: Column) -> Column:
    """Metadata as VARIANT; empty, null and unparsable text become ``{}``."""
    return F.coalesce(
        F.when(is_json(metadata), F.try_parse_json(metadata)), F.parse_json(F.lit(EMPTY_JSON))
    )


def clean_metadata(metadata: Column) -> Column:
    """Metadata text that is certain to parse."""
    return F.when(is_json(metadata), metadata).otherwise(F.lit(EMPTY_JSON))


def json_path(key: str) -> str:
    """Path of a top-level key; quotes keep dots in the key literal."""
    if "'" in key:
        raise ValueError(f"a metadata key must not contain a quote: {key!r}")
    return f"$['{key}']"


def json_text(metadata: Column, key: str) -> Column:
    return F.get_json_object(metadata, json_path(key))


def metadata_filter(metadata: Column, conditions: dict) -> Column:
    """AND of equality tests on top-level keys.

    Strings compare as text, numbers as doubles, booleans as JSON booleans, a
    list as membership. Other value types are ignored.
    """
    predicate = F.lit(True)
    for key, value in conditions.items():
        if isinstance(value, bool):
            found = F.try_variant_get(F.try_parse_json(metadata), json_path(key), "variant")
            # A JSON string "true" would convert to a boolean, but is not one.
            test = (F.schema_of_variant(found) == "BOOLEAN") & (json_text(metadata, key) == str(value).lower())
        elif isinstance(value, str):
            test = json_text(metadata, key) == value
        elif isinstance(value, (int, float)):
            test = json_text(metadata, key).try_cast("double") == float(value)
        elif isinstance(value, (list, tuple, set, frozenset)):
            test = json_text(metadata, key).isin([str(v) for v in value])
        else:
            continue
        predicate = predicate & test
    return predicate


def promote_keys(metadata: Column, keys: dict[str, str]) -> list[Column]:
    """Typed columns for chosen keys, so that filters reach the parquet scan."""
    parsed = F.try_parse_json(metadata)
    return [
        F.try_variant_get(parsed, json_path(key), sql_type).alias(f"meta_{key}")
        for key, sql_type in keys.items()
    ]


def promoted_filter(df: DataFrame, conditions: dict) -> Column:
    """The tests of :func:`metadata_filter` on the promoted columns of ``df``.

    Tests compare a column with constants of its own type, so they reach the
    scan's row groups. A key without a promoted column is an error.
    """
    predicate = F.lit(True)
    for key, value in conditions.items():
        name = f"meta_{key}"
        if name not in df.columns:
            raise ValueError(f"metadata key {key!r} is not promoted in this index")
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        whole = isinstance(kind, T.IntegralType)
        if isinstance(value, bool):
            test = column == F.lit(value) if isinstance(kind, T.BooleanType) else F.lit(False)
        elif isinstance(value, (int, float)):
            if isinstance(kind, T.StringType):
                test = column.try_cast("double") == float(value)
            else:
                test = F.lit(False) if whole and value != int(value) else column == F.lit(int(value) if whole else float(value))
        elif isinstance(value, (str, list, tuple, set, frozenset)):
            texts = [value] if isinstance(value, str) else [str(v) for v in value]
            if whole:
                # Only the plain spelling of a number is the text of one.
                test = column.isin([n for t in texts for n in [int(t) if t.lstrip("-").isdecimal() else None] if n is not None and str(n) == t])
            elif isinstance(kind, T.StringType):
                test = column.isin(texts) if len(texts) != 1 else column == texts[0]
            else:
                test = column.cast("string").isin(texts)
        else:
            continue
        predicate = predicate & test
    return predicate
