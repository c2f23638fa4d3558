"""Mixing sources to target weights by systematic sampling.

Every source has a target, a share of all words. Its documents are put in
order of size, the largest first, each expects some copies, and the running
sum of expected copies, moved by one random offset per source, passes whole
numbers; a document is taken once for each number passed at it.

A document of the ``HEAD`` largest of its source expects what the target still
lacks over the words still to come, so that a large document taken or left is
made up by those after it. It is not taken beyond the target where the later ones can fill
it, and is taken where all of them three times could not: a document larger than its source's
target is left out if the others suffice. All documents after the head expect
the same number, so the words taken differ from the target by about one document that is
smaller than all of the head.

Positions within a source come from a range partition with counts per
partition, so a source that holds most rows is ordered by many tasks.

Defined cases: a null text has size 0, and documents of size 0 are taken like
others, adding no words. A null source is a source of its own, listed last.
Rows with equal or null ids are separate rows. A source without any word gets
target 0 and no copy. The offset is drawn from a seed and the source's name, so reruns
agree. Columns named like an output column are replaced.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import let, stored, unused, whole, with_row_key, words
from lakeretrieve.llm.registry import QUERIES, table
from lakeretrieve.plans.topk import with_positions

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
# Largest documents of a source whose expected copies follow what is still lacking.
HEAD = 64


def size_of(text: str | Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> dict[str | None, float]:
    """Words wanted of each source.

    Sources in code point order, null last, weigh ``weights`` in turn. Targets
    share all words by weight; one above ``most`` times its source stops
    there, and the rest is shared again among the others until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    found: dict[str | None, float] = {}
    left, open_ = float(sum(sizes.values())), names
    while open_:
        total = sum(weight[s] for s in open_)
        shares = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if shares[s] > most * sizes[s]]
        if not above:
            return found | shares
        for s in above:
            found[s] = float(most * sizes[s])
            left -= found[s]
        open_ = [s for s in open_ if s not in found]
    return found


def _plan(spark: SparkSession, sized: DataFrame, seed: int) -> DataFrame:
    """One row per source: its size, target and offset."""
    sizes = {r["source"]: r["words"] for r in sized.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    wanted = targets(sizes)
    rows = [(s, n, float(wanted[s]), random.Random(f"{seed}:{s!r}").random()) for s, n in sizes.items()]
    return spark.createDataFrame(rows, "plan_source string, source_size long, target double, offset double")


def _between(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, value))


def _head(state: Column, size: Column) -> Column:
    """The state after a document of the head: sum of expected copies, words lacking and to come, copies."""
    none, most = F.lit(0).cast("long"), F.lit(MOST_COPIES).cast("long")
    lacking, size_ = state["lacking"], F.greatest(size, F.lit(1)).cast("double")
    expected = F.when(state["words"] > 0, _between(lacking / state["words"], F.lit(0.0), F.lit(float(MOST_COPIES)))).otherwise(F.lit(0.0))
    drawn = F.least(most, (F.floor(state["at"] + expected) - F.floor(state["at"])).cast("long"))
    # The later documents give three times their words at most.
    later = MOST_COPIES * (state["words"] - size)
    room = _between(F.floor(lacking / size_).cast("long"), none, most)
    need = _between(F.ceil((lacking - later) / size_).cast("long"), none, most)
    nearer = F.when(need * size_ - lacking < lacking - later - room * size_, need).otherwise(room)
    copies = F.when(size == 0, drawn).when(need <= room, _between(drawn, need, room)).otherwise(nearer)
    return let(
        copies,
        lambda n: F.struct(
            (state["at"] + expected).alias("at"),
            (lacking - n * size).alias("lacking"),
            (state["words"] - size).alias("words"),
            F.concat(state["copies"], F.array(n)).alias("copies"),
        ),
    )


def _heads(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per source: copies of its head, and what each document after it expects, with the offset reached."""
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("position", "size"))), lambda x: x["size"])
    heads = placed.where(F.col("position") <= HEAD).groupBy("source").agg(sizes.alias("sizes"))
    start = F.struct(
        F.col("offset").alias("at"),
        F.col("target").alias("lacking"),
        F.col("source_size").cast("double").alias("words"),
        F.array().cast("array<bigint>").alias("copies"),
    )
    # Rounded down, so that no document is taken more than three times.
    exact = lambda x: (F.floor(x * 1e12) / F.lit(1e12)).cast("decimal(18,15)")
    rest = _between(F.col("state.lacking") / F.col("state.words"), F.lit(0.0), F.lit(float(MOST_COPIES)))
    return (
        heads.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("state", F.aggregate("sizes", start, _head))
        .select(
            "plan_source",
            "source_size",
            "target",
            F.col("state.copies").alias("head"),
            F.when(F.col("state.words") > 0, exact(rest)).otherwise(F.lit(0).cast("decimal(18,15)")).alias("expected"),
            exact(F.col("state.at") - F.floor("state.at")).alias("reached"),
        )
    )


def _passed() -> Column:
    """Whole numbers passed at a position after the head: the copies of its document."""
    upto = lambda at: F.floor(at.cast("decimal(20,0)") * F.col("expected") + F.col("reached"))
    return (upto(F.col("position") - HEAD) - upto(F.col("position") - HEAD - 1)).cast("long")


def copies(sized: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """``key, size, source_size, target, copies`` for rows of ``key, source, size``.

    Equal sizes are ordered by ``key``. The driver sees one row per source.
    """
    falling = sized.withColumn("falling", -F.col("size"))
    placed = stored(with_positions(falling, ["source"], ["falling", key]).drop("falling"), "placed")
    heads = stored(_heads(placed, _plan(sized.sparkSession, sized, seed)), "heads")
    return placed.join(heads, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        key,
        "size",
        "source_size",
        "target",
        F.when(F.col("position") <= HEAD, F.get("head", (F.col("position") - 1).cast("int"))).otherwise(_passed()).alias("copies"),
    )


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns.

    The rows are stored once with a row number; sizes and positions travel
    without texts, and the texts meet their copies in one join on that number,
    which no row shares.
    """
    key = unused("__row", docs)
    numbered = with_row_key(docs, key)
    sized = stored(numbered.select(F.col(key).alias("__row"), "source", size_of("text").alias("size")), "sizes")
    of, times = unused("__of", numbered), unused("__times", numbered)
    taken = copies(sized, "__row", seed).where("copies > 0").select(F.col("__row").alias(of), F.col("copies").alias(times))
    repeated = numbered.join(taken, F.col(key) == F.col(of)).withColumn(
        unused("__copy", numbered), F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))
    )
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", size_of("text").alias("size")), "sizes")
    return copies(sized, "doc_id").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


QUERIES["op8_source_mix"] = op8_source_mix
