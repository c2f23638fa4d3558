"""Analyzers and text-match expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Analyzer names. Unknown names use the default.
ANALYZERS = ("unicode", "standard", "english", "chinese", "ik", "keyword")
DEFAULT_ANALYZER = "unicode"

# Common English words left out by the english analyzer.
ENGLISH_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]

# One Han character, or a run of other letters and digits.
TOKEN_PATTERN = r"(\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+)"
RUN_PATTERN = r"(\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+)"

# Joins tokens for the phrase test; no analyzer but keyword can produce it.
_GAP = "\u0001"

# Mode names of the two search classes; unknown means phrase.
_MODES = {"phrase": "phrase", "all": "all", "boolean": "all", "any": "any", "natural": "any"}


def match_mode(mode: str) -> str:
    """``phrase``, ``all`` or ``any`` for any accepted mode name."""
    return _MODES.get(mode.lower(), "phrase")


def tokenize(text: Column, analyzer: str = DEFAULT_ANALYZER) -> Column:
    """Tokens of the whole text, in order."""
    name = analyzer.lower()
    if name == "keyword":
        return F.when(F.length(text) > 0, F.array(text)).when(
            text.isNotNull(), F.array().cast("array<string>")
        )
    if name in ("chinese", "ik"):
        runs = F.regexp_extract_all(F.lower(text), F.lit(RUN_PATTERN), F.lit(1))
        return F.flatten(
            F.transform(
                runs,
                lambda run: F.when(
                    run.rlike(r"^\p{IsHan}{2,}$"),
                    F.transform(
                        F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))),
                        lambda i: F.substring(run, i, F.lit(2)),
                    ),
                ).otherwise(F.array(run)),
            )
        )
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(1))
    if name == "english":
        stop = [F.lit(word) for word in ENGLISH_STOP_WORDS]
        return F.filter(tokens, lambda t: ~t.isin(*stop))
    return tokens


def _joined(tokens: Column) -> Column:
    return F.concat(F.lit(_GAP), F.array_join(tokens, _GAP), F.lit(_GAP))


def tokens_match(mode: str, tokens: Column, query_tokens: Column) -> Column:
    """Whether tokenised text matches; a query without tokens never does."""
    kind = match_mode(mode)
    if kind == "phrase":
        hit = F.contains(_joined(tokens), _joined(query_tokens))
    elif kind == "all":
        hit = F.size(F.array_except(query_tokens, tokens)) == 0
    else:
        hit = F.arrays_overlap(tokens, query_tokens)
    return (F.size(query_tokens) > 0) & hit


def match(mode: str, text: Column, query: Column | str, analyzer: str = DEFAULT_ANALYZER) -> Column:
    """``match`` of a text column with one query under the named mode.

    A query given as text is tested as substrings first, so that texts which
    cannot match are not tokenised.
    """
    if not isinstance(query, str):
        return tokens_match(mode, tokenize(text, analyzer), tokenize(query, analyzer))
    asked = tokenize(F.lit(query), analyzer)
    exact = tokens_match(mode, tokenize(text, analyzer), asked)
    if analyzer.lower() == "keyword":
        return exact
    lowered = F.lower(text)
    some = F.exists if match_mode(mode) == "any" else F.forall
    return some(asked, lambda word: F.contains(lowered, word)) & exact


def match_phrase(text: Column, query: Column | str, analyzer: str = DEFAULT_ANALYZER) -> Column:
    return match("phrase", text, query, analyzer)


def match_all(text: Column, query: Column | str, analyzer: str = DEFAULT_ANALYZER) -> Column:
    return match("all", text, query, analyzer)


def match_any(text: Column, query: Column | str, analyzer: str = DEFAULT_ANALYZER) -> Column:
    return match("any", text, query, analyzer)
