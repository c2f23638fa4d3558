"""Secret scans: fixed patterns, and random strings found by two Markov models.

The patterns give the base spans. Further spans are long tokens that a
character Markov model of random strings explains better than one of ordinary
identifiers; the score is the mean log-likelihood ratio of a transition. Both
models are transition counts, made by grouped aggregation from labelled samples:
values of the base patterns are random strings, other tokens of the same texts'
corpus are ordinary. The cut is learned from the same samples.

All work is column expressions; the models reach the executors as one literal
array of ``alphabet x alphabet`` numbers.

Defined cases: a null text counts as empty and has no spans. Rows with equal or
null ids are scanned each by itself. Without a base value anywhere there is no
model of random strings, and only base spans are reported. Input columns named
like an output column are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import let, stored, whole
from lakeretrieve.llm.registry import QUERIES, table

# Fixed patterns; the kinds in the order in which spans of one place are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
MIN_ASSIGNED = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
TOKEN = r"[A-Za-z0-9+/_.=-]+"
MIN_TOKEN = 16
CANDIDATE = r"[A-Za-z0-9+/_.=-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_.=-]{6,}"
# Matches of a text whose places are summed up together.
BLOCK = 256


def _blocks(values: Column) -> Column:
    """An array, already computed, in blocks of ``BLOCK`` values."""
    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    cut = F.transform(starts, lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.size(values) > 0, cut).otherwise(F.slice(F.array(values), 1, 0))


def _sums(values: Column) -> Column:
    """Running sums, first included; the array is copied at each step, so it is to be short."""
    add = lambda sums, x: F.concat(sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0).cast("long")) + x))
    return F.aggregate(values, F.array().cast("array<bigint>"), add)


def spans(text: Column, pattern: str, order: int, keep=None) -> Column:
    """Places of all matches: an array of (start, end, order), in code points.

    The text between the matches and the matches take turns, so ends are running
    sums of their lengths: of blocks first, then within each block, as a
    running sum copies what it has so far at each step.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        parts = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(found)),
            found,
            lambda gap, match: F.struct((F.length(gap) + F.length(match)).cast("long").alias("n"), match.alias("match")),
        )

        def of_blocks(blocks: Column) -> Column:
            total = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda n, x: n + x["n"])
            reached = _sums(F.transform(blocks, total))
            return let(reached, lambda ends: F.flatten(F.transform(blocks, lambda block, i: in_block(block, ends[i] - total(block)))))

        def in_block(block: Column, start: Column) -> Column:
            def span(part: Column, upto: Column) -> Column:
                end = start + upto
                match = part["match"]
                return F.struct((end - F.length(match)).alias("start"), end.alias("end"), F.lit(order).alias("ord"), match.alias("text"))

            return F.zip_with(block, _sums(F.transform(block, lambda x: x["n"])), span)

        return let(parts, lambda each: let(_blocks(each), of_blocks))

    none = F.array().cast("array<struct<start:bigint,end:bigint,ord:int,text:string>>")
    wanted = F.size(matches) > 0 if keep is None else F.exists(matches, keep)
    every = F.when(wanted, let(matches, placed)).otherwise(none)
    return every if keep is None else F.filter(every, lambda s: keep(s["text"]))


def _free(likely: Column, base: Column) -> Column:
    """Spans of ``likely`` that meet none of ``base``; each block is compared with the base spans around it."""
    meets = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])

    def of_block(block: Column) -> Column:
        around = F.struct(block[0]["start"].alias("start"), F.element_at(block, -1)["end"].alias("end"))
        near = F.filter(base, lambda b: meets(around, b))
        return let(near, lambda those: F.filter(block, lambda s: ~F.exists(those, lambda b: meets(s, b))))

    return F.flatten(F.transform(_blocks(likely), of_block))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns; each is looked for where it can occur."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,ord:int,text:string>>")
    long_enough = lambda match: F.length(F.regexp_extract(match, ASSIGN, 2)) >= MIN_ASSIGNED
    assign = F.when(text.contains("=") | text.contains(":"), spans(text, ASSIGN, 0, long_enough)).otherwise(none)
    access = F.when(text.contains("AKIA"), spans(text, ACCESS, 1)).otherwise(none)
    return F.concat(assign, access, spans(text, HEX, 2))


@dataclass(frozen=True)
class RandomModel:
    """Log-likelihood ratios of transitions, and the least mean ratio of a secret."""

    ratios: tuple[float, ...]
    cut: float

    def score(self, token: Column) -> Column:
        """Mean ratio of a token's transitions; null for one character."""
        steps = F.split(F.lit(",".join(f"{r:.4f}" for r in self.ratios)), ",").cast("array<double>")
        place = lambda c: F.instr(F.lit(ALPHABET), c) - 1

        def summed(c: Column) -> Column:
            each = F.zip_with(
                F.slice(c, F.lit(1), F.size(c) - 1),
                F.slice(c, F.lit(2), F.size(c) - 1),
                lambda a, b: F.get(steps, place(a) * len(ALPHABET) + place(b)),
            )
            return F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / (F.size(c) - 1)

        return F.when(F.length(token) >= 2, let(F.split(token, ""), summed))


def _transitions(tokens: DataFrame) -> dict[str, int]:
    """Counts of neighbouring characters; at most ``alphabet x alphabet`` rows."""
    characters = F.split("token", "")
    pairs = F.zip_with(
        F.slice(characters, F.lit(1), F.size(characters) - 1),
        F.slice(characters, F.lit(2), F.size(characters) - 1),
        lambda a, b: F.concat(a, b),
    )
    rows = tokens.where(F.length("token") >= 2).select(F.explode(pairs).alias("pair")).groupBy("pair").count()
    return {row["pair"]: row["count"] for row in rows.collect()}


def _log_likelihoods(counts: dict[str, int], smoothing: float = 0.5) -> dict[str, float]:
    found = {}
    for a in ALPHABET:
        total = sum(counts.get(a + b, 0) for b in ALPHABET) + smoothing * len(ALPHABET)
        found |= {a + b: math.log((counts.get(a + b, 0) + smoothing) / total) for b in ALPHABET}
    return found


def labelled_samples(docs: DataFrame, max_texts: int, max_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Random strings and ordinary identifiers, each a bounded sample.

    Random: values of base patterns, the ``max_tokens`` of smallest hash.
    Ordinary: other tokens of the ``max_texts`` different texts of smallest hash, and of
    them the ``max_tokens`` of smallest hash. Only hashes are ordered; the texts are
    read again and those with a chosen hash are cut into tokens where they lie.
    """
    text = whole("text")
    values = docs.select(F.explode(base_spans(text)).alias("span")).select(
        F.when(F.col("span.ord") == 0, F.regexp_extract("span.text", ASSIGN, 2)).otherwise(F.col("span.text")).alias("token")
    )
    random = values.where(F.length("token") >= MIN_TOKEN).distinct().orderBy(F.xxhash64("token"), "token").limit(max_tokens)
    hashed = docs.select(F.xxhash64(text).alias("hash"), text.alias("text"))
    chosen = hashed.select("hash").distinct().orderBy("hash").limit(max_texts)
    picked = hashed.join(F.broadcast(chosen), "hash", "left_semi")
    ordinary = (
        picked.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("token"))
        .distinct()
        .orderBy(F.xxhash64("token"), "token")
        .limit(max_tokens)
    )
    fixed = stored(random, "random")
    return fixed, stored(ordinary.join(fixed, "token", "left_anti"), "ordinary")


def train(docs: DataFrame, max_texts: int = 500, max_tokens: int = 20000) -> RandomModel | None:
    """Both models and the cut, from the bounded samples of :func:`labelled_samples`.

    The cut lies above 99.9 % of the ordinary sample and above zero; tokens of
    at least ``MIN_TOKEN`` characters are compared with it.
    """
    random, ordinary = labelled_samples(docs, max_texts, max_tokens)
    random_counts, ordinary_counts = _transitions(random), _transitions(ordinary)
    if not random_counts or not ordinary_counts:
        return None
    a, b = _log_likelihoods(random_counts), _log_likelihoods(ordinary_counts)
    model = RandomModel(tuple(a[x + y] - b[x + y] for x in ALPHABET for y in ALPHABET), 0.0)
    high = ordinary.agg(F.percentile(model.score(F.col("token")), 0.999)).first()[0]
    return RandomModel(model.ratios, max(0.1, (high or 0.0) + 0.1))


def with_secrets(docs: DataFrame, model: RandomModel | None, text: str = "text") -> DataFrame:
    """Documents with ``base`` and ``secrets``: spans of base patterns, and all spans."""
    base = docs.withColumn("base", F.array_sort(base_spans(whole(text))))
    if model is None:
        return base.withColumn("secrets", F.col("base"))
    likely = spans(whole(text), CANDIDATE, 3, lambda token: model.score(token) >= F.lit(model.cut))
    free = let(likely, lambda found: _free(found, F.col("base")))
    return base.withColumn("secrets", F.array_sort(F.concat("base", free)))


def _listed(spans_of: str) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["ord"] + 1)
    ordered = F.array_sort(F.transform(spans_of, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda order: F.size(F.filter("base", lambda s: s["ord"] == order)).cast("long")
    return with_secrets(docs, train(docs)).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("secrets").alias("spans"),
    )


QUERIES["op9_secret_scan"] = op9_secret_scan
