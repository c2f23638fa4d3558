"""Expressions on chat messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeretrieve.functions.metadata import is_json

# Control characters that a stored message must not hold
# (tab, line feed and carriage return stay).
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"


def clean_text(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_CHARACTERS, "")


def speaker(kind: Column) -> Column:
    """Label of a message type in a transcript."""
    return F.when(kind == "human", "Human").when(kind == "ai", "AI").otherwise(F.initcap(kind))


def transcript_line(kind: Column, content: Column) -> Column:
    return F.concat(speaker(kind), F.lit(": "), content)


def model_role(kind: Column) -> Column:
    """Role name for a chat model: human is the user, all else the assistant."""
    return F.when(kind == "human", "user").otherwise("assistant")


def message_json(kind: Column, content: Column) -> Column:
    """Compact JSON of one message, without control characters."""
    return clean_text(
        F.to_json(F.struct(kind.alias("type"), F.struct(content.alias("content")).alias("data")))
    )


def parse_message(message: Column) -> Column:
    """``struct(type, content)``, null when the text does not parse.

    Control characters that a writer left in are removed first.
    """
    message = clean_text(message)
    parsed = F.when(is_json(message), F.try_parse_json(message))
    kind = F.try_variant_get(parsed, "$.type", "string")
    return F.when(
        parsed.isNotNull() & kind.isNotNull(),
        F.struct(
            kind.alias("type"),
            F.coalesce(F.try_variant_get(parsed, "$.data.content", "string"), F.lit("")).alias("content"),
        ),
    )
