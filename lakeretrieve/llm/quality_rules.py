"""Quality rules: decision lists learned from labelled statistics.

:func:`with_statistics` counts words, symbols and repeats of each whole text
with column expressions. :func:`learn_rules` grows and prunes conjunctions of
thresholds by sequential covering; every count it looks at is one grouped
aggregation over all labelled rows, so the driver sees a histogram of
``features x bins`` rows and never a document. :func:`verdict` turns the list
into one ordered conditional expression.

Defined cases: a null text counts as empty and has no words, so it fails the
base rule of 50 words. Rows with equal or null ids are judged each by itself.
A label that is null is no label; several labels of one id count as bad if one
of them is. Without labels of both kinds there are no rules and the base
rule decides alone. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import NON_SPACE, let, stored, whole, words
from lakeretrieve.llm.registry import QUERIES, table
from lakeretrieve.plans.blocks import candidate_filter, filter_bits, may_hold

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = [*COUNTS, "n_chars_all", "n_upper", "n_bars", "n_exclaims"]

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(found: Column) -> Column:
    """Words inside three-word windows that occur twice or more in one text.

    Windows are sorted with their positions, so equal ones become neighbours;
    each neighbouring pair gives both its positions, and the positions'
    windows are united.
    """
    windows = F.size(found) - 2

    def covered(ordered: Column) -> Column:
        pairs = F.zip_with(
            F.slice(ordered, 1, windows - 1),
            F.slice(ordered, 2, windows - 1),
            lambda a, b: F.when(
                (a["second"] == b["second"]) & (a["first"] == b["first"]) & (a["third"] == b["third"]),
                F.array(a["at"], a["at"] + 1, a["at"] + 2, b["at"], b["at"] + 1, b["at"] + 2),
            ),
        )
        return F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    triples = F.arrays_zip(
        F.slice(found, 1, windows).alias("first"),
        F.slice(found, 2, windows).alias("second"),
        F.slice(found, 3, windows).alias("third"),
        F.sequence(F.lit(0), windows - 1).alias("at"),
    )
    return F.when(F.size(found) >= 4, let(F.sort_array(triples), covered)).otherwise(F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def statistics(text: str | Column) -> Column:
    """All counts of one text as a struct of longs."""
    clean = whole(text)
    lines = F.filter(F.split(clean, "\n"), lambda line: line.rlike(NON_SPACE))
    parts = let(
        words(clean),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    others = {
        "n_symbols": _without(clean, r"[#*$%&|<>]+"),
        "n_dup_lines": let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))),
        "n_chars_all": F.length(clean),
        "n_upper": _without(clean, r"[A-Z]+"),
        "n_bars": _without(clean, r"\|+"),
        "n_exclaims": _without(clean, r"!+"),
    }
    named = {c: F.lit(None) for c in STATISTICS} | others
    return let(
        parts,
        lambda p: F.struct(
            *[(p[c] if c in ("n_words", "word_chars", "n_repeat_words") else named[c]).cast("long").alias(c) for c in STATISTICS]
        ),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with the columns of :data:`STATISTICS`."""
    counted = docs.withColumn("__stat", statistics(text))
    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in STATISTICS],
        *[F.col("__stat")[c].alias(c) for c in STATISTICS],
    )


Count = Callable[[str], Column]


def base_failed(count: Count = F.col) -> Column:
    """The base rule on counts named by ``count``."""
    return (count("n_words") < MIN_WORDS) | (100 * count("n_repeat_words") > MAX_REPEAT_PERCENT * count("n_words"))


# Each feature is one count by another.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "n_chars_all"),
    "bars_per_word": ("n_bars", "n_words"),
    "exclaims_per_word": ("n_exclaims", "n_words"),
}


def ratio(name: str, count: Count = F.col) -> Column:
    part, total = FEATURES[name]
    return count(part) / F.greatest(count(total), F.lit(1))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def expression(self, count: Count = F.col) -> Column:
        value = ratio(self.feature, count)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """A conjunction whose rows are rejected; its counts on the pruning part."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def expression(self, count: Count = F.col) -> Column:
        found = F.lit(True)
        for c in self.conditions:
            found = found & c.expression(count)
        return found


def _thresholds(binned: DataFrame, bins: int) -> dict[str, list[float]]:
    """Cut points of each feature: quantiles of the bad rows and of the good rows."""
    at = [i / bins for i in range(bins + 1)]
    rows = binned.groupBy("bad").agg(*[F.percentile_approx(ratio(name), at, 10000).alias(name) for name in FEATURES])
    cuts: dict[str, set[float]] = {name: set() for name in FEATURES}
    for row in rows.collect():
        for name in FEATURES:
            cuts[name].update(row[name] or [])
    # Half-way between neighbouring quantiles, so that a cut stands off the rows on both sides.
    return {name: [(a + b) / 2 for a, b in zip(s, s[1:])] for name, s in ((n, sorted(v)) for n, v in cuts.items())}


def _histogram(binned: DataFrame, features: list[str]) -> dict[str, dict[int, tuple[int, int]]]:
    """Bad and good rows of each bin of each feature; ``features x bins`` rows."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in features]))
    counts = (
        binned.select("bad", each.alias("x"))
        .groupBy("x.feature", "x.bin")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    )
    found: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in features}
    for row in counts.collect():
        found[row["feature"]][row["bin"]] = (row["bad"], row["good"])
    return found


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    if not after[0]:
        return -1.0
    bits = lambda p: math.log2(p[0] / (p[0] + p[1]))
    return after[0] * (bits(after) - bits(before))


def _best(histogram, before: tuple[int, int]):
    """The one-sided cut of highest information gain: (gain, feature, at_least, bin)."""
    best = (0.0, "", True, 0, before)
    for feature in sorted(histogram):
        bins = histogram[feature]
        below = (0, 0)
        for cut in sorted(bins):
            above = (before[0] - below[0], before[1] - below[1])
            for at_least, counts in ((True, above), (False, below)):
                gain = _gain(before, counts)
                if gain > best[0] + 1e-9:
                    best = (gain, feature, at_least, cut, counts)
            below = (below[0] + bins[cut][0], below[1] + bins[cut][1])
    return best


def learn_rules(
    counted: DataFrame,
    labels: DataFrame,
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 32,
    min_precision: float = 0.9,
    min_rows: int = 4,
) -> list[Rule]:
    """Sequential covering over all labelled rows of ``counted``.

    Two thirds of the labelled rows, chosen by a hash of the id, grow a rule
    condition by condition; the last third decides how many of its conditions
    stay. A rule is taken if its precision on both parts reaches
    ``min_precision``; then the rows it covers are set aside and the next rule
    is grown. Rows the base rule already rejects teach nothing and are left out.
    """
    known = (
        labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"))
        .where(F.col("__id").isNotNull() & F.col("__quality").isNotNull())
        .groupBy("__id")
        .agg((1 - F.min("__quality").cast("int")).alias("bad"))
    )
    joined = counted.where(~base_failed()).join(known, F.col("doc_id") == F.col("__id")).select("doc_id", "bad", *STATISTICS)
    labelled = stored(joined, "labelled")
    cuts = {name: c for name, c in _thresholds(labelled, bins).items() if c}
    if not cuts or labelled.select("bad").distinct().count() < 2:
        return []
    bin_of = lambda name: F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda c: c <= ratio(name)))
    binned = stored(
        labelled.select(
            "bad",
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("pruning"),
            *[bin_of(name).alias(f"bin_{name}") for name in cuts],
        ),
        "binned",
    )
    test = lambda c: F.col(f"bin_{c[0]}") >= c[2] if c[1] else F.col(f"bin_{c[0]}") < c[2]

    def all_of(conditions) -> Column:
        found = F.lit(True)
        for c in conditions:
            found = found & test(c)
        return found

    def totals(rows: DataFrame) -> tuple[int, int]:
        row = rows.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count(F.lit(1))).first()
        return row[0], row[1] - row[0]

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        growing, pruning = left.where(~F.col("pruning")), left.where("pruning")
        counts, conditions = totals(growing), []
        while counts[0] and counts[1] and len(conditions) < max_conditions:
            gain, feature, at_least, cut, after = _best(_histogram(growing.where(all_of(conditions)), list(cuts)), counts)
            if gain <= 0 or cut == 0:
                break
            conditions.append((feature, at_least, cut))
            counts = after
        if not conditions or counts[0] < min_rows or counts[0] < min_precision * sum(counts):
            break
        # The shortest beginning of the rule that does best on rows it was not grown on.
        checks = [F.sum(F.when(all_of(conditions[:n]), x).otherwise(0)) for n in range(1, len(conditions) + 1) for x in (F.col("bad"), 1 - F.col("bad"))]
        seen = [x or 0 for x in pruning.agg(*checks).first()]
        worth = [((b - g) / (b + g) if b + g else -1.0, -n, b, g) for n, (b, g) in enumerate(zip(seen[::2], seen[1::2]))]
        value, n, bad, good = max(worth)
        if bad < min_precision * (bad + good) or not bad:
            break
        conditions = conditions[: 1 - n]
        rules.append(Rule(tuple(Condition(f, up, cuts[f][c - 1]) for f, up, c in conditions), bad, good))
        left = left.where(~all_of(conditions))
    return rules


def verdict(rules: list[Rule], count: Count = F.col) -> Column:
    """The ordered list as one conditional expression: false if rejected."""
    found = F.when(base_failed(count), F.lit(False))
    for rule in rules:
        found = found.when(rule.expression(count), F.lit(False))
    return found.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    counted = stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    rules = learn_rules(counted, labels)
    return counted.select("doc_id", *COUNTS, base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the list keeps, with their own columns.

    Learning counts labelled texts only, found by a bit map of the labelled ids
    that lets a few others through; those meet no label. The learned list then
    filters the scan and counts each text there. No text is shuffled.
    """
    ids = labels.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"))
    bits = filter_bits(ids.count())
    near = may_hold(docs.select("doc_id", "text"), ["doc_id"], candidate_filter(ids, ["doc_id"], bits), bits)
    counted = stored(with_statistics(near).drop("text"), "statistics")
    rules = learn_rules(counted, labels)
    return docs.where(let(statistics("text"), lambda counts: verdict(rules, lambda name: counts[name])))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op10_quality_rules"] = op10_quality_rules
