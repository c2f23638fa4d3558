"""Filter interaction audit: what each filter removes in every order of the filters.

The filters applied so far are a state, a subset of all filters; applying one
more is an edge of the subset lattice. The rows an edge removes fail its filter
and none of the state's. Orders are paths from the empty to the full
subset: counted forward, they tell how many orders reach a state, counted
backward, how many leave it. An edge lies on the product of both, which weighs
its removals in a filter's Shapley sum; each order's steps are read from the
same edges.

Texts are seen once, for a bit per filter they fail. Copies of a text meet by
a 256-bit hash, summed up before the shuffle, so that a hot text is a few rows;
what is left of a part is at most one row for each set of failures.

Defined cases: a null text counts as empty, a null part as the empty string. A
null id is smaller than none and has no label; equal ids are not smaller than
each other. Of several labels of one id a 1 counts. Other columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import let, whole, words
from lakeretrieve.llm.registry import ORACLES, QUERIES, table

MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = r"[#$%&*|]"
FILTERS = ("A", "B", "C", "D", "E")


def failed_alone(text: str | Column) -> Column:
    """Bits 0 to 3: the filters that look at a text by itself, A to D, which it fails."""
    clean = whole(text)
    upper = F.length(clean) - F.length(F.regexp_replace(clean, "[A-Z]+", ""))

    def bits(found: Column) -> Column:
        n = F.size(found)
        failures = [
            n < MIN_WORDS,
            100 * F.size(F.array_distinct(found)) < DISTINCT_PERCENT * n,
            100 * upper > UPPER_PERCENT * F.length(clean),
            clean.rlike(SYMBOLS),
        ]
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures)), F.lit(0))

    return let(words(clean), bits)


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail, E being a repeated text."""
    yes = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("long"), F.lit(0)))
    known = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").alias("__labelled"))
        .agg(yes("quality").alias("good"), yes("toxic").alias("toxic"))
    )
    seen = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").alias("id"),
        F.unhex(F.sha2(whole("text"), 256)).alias("same"),
        failed_alone("text").alias("mask"),
    )
    flag = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    named = seen.join(known, F.col("id") == F.col("__labelled"), "left").select(*seen.columns, flag("good"), flag("toxic"))
    kind = ["same", "part", "mask", "good", "toxic"]
    by_id = named.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    kinds = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    smallest = kinds.groupBy(F.col("same").alias("text")).agg(F.min("least.id").alias("smallest"))
    met = kinds.join(smallest, F.col("same") == F.col("text"))
    first = F.col("unnamed") + F.when(F.col("least.id") == F.col("smallest"), F.col("least.n")).otherwise(0)
    repeated = 1 << (len(FILTERS) - 1)
    either = F.inline(
        F.array(
            F.struct(F.col("mask").alias("failed"), first.alias("rows")),
            F.struct((F.col("mask") + repeated).alias("failed"), (F.col("n") - first).alias("rows")),
        )
    )
    return (
        met.select("part", "good", "toxic", either)
        .where("rows > 0")
        .groupBy("part", F.col("failed").alias("mask"))
        .agg(F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("good")).alias("good"), F.sum(F.col("rows") * F.col("toxic")).alias("toxic"))
    )


class Lattice:
    """The subsets of some filters: edges, orders through each edge, and the edges of each order's steps."""

    def __init__(self, names: Sequence[str]):
        size = len(names)
        full = (1 << size) - 1
        self.names = list(names)
        self.edges = [(state, f) for state in range(full + 1) for f in range(size) if not state >> f & 1]
        self.number = {edge: i for i, edge in enumerate(self.edges)}
        reaching, leaving = [1] + [0] * full, [0] * full + [1]
        for state, f in self.edges:
            reaching[state | 1 << f] += reaching[state]
        for state, f in reversed(self.edges):
            leaving[state] += leaving[state | 1 << f]
        self.orders_through = [reaching[state] * leaving[state | 1 << f] for state, f in self.edges]
        self.full = full

    def steps(self) -> list[dict]:
        """Each step of each order: the edges up to it, and its filter's first and last possible edge."""
        found = []
        for order in itertools.permutations(range(len(self.names))):
            state, path = 0, []
            for step, f in enumerate(order, 1):
                path = [*path, self.number[state, f]]
                state |= 1 << f
                found.append(
                    {
                        "filter_order": "".join(self.names[x] for x in order),
                        "step": step,
                        "filter": f,
                        "path": path,
                        "alone": self.number[0, f],
                        "last": self.number[self.full ^ 1 << f, f],
                    }
                )
        return found


def audit(counts: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """One row for each part, order and step, from ``part, mask, n, good, toxic``."""
    lattice = Lattice(names)
    fields = ("n", "good", "toxic")
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("mask", *fields)).alias("masks"))
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)

    def removals(edge: Column) -> Column:
        here = F.filter(
            "masks",
            lambda m: (m["mask"].bitwiseAND(edge["bit"]) != 0) & (m["mask"].bitwiseAND(edge["state"]) == 0),
        )
        total = lambda rows, name: F.aggregate(rows, F.lit(0).cast("long"), lambda s, m: s + m[name])
        return let(here, lambda rows: F.struct(*[total(rows, name).alias(name) for name in fields]))

    edges = constant([{"bit": 1 << f, "state": state} for state, f in lattice.edges], "array<struct<bit:int,state:int>>")
    weights = constant(
        [[w if at == f else 0 for w, (_, at) in zip(lattice.orders_through, lattice.edges)] for f in range(len(names))],
        "array<array<bigint>>",
    )
    walked = parts.withColumn("edges", F.transform(edges, removals))
    weighed = walked.withColumn(
        "sums",
        F.transform(
            weights,
            lambda each: F.aggregate(F.zip_with(each, "edges", lambda w, e: w * e["n"]), F.lit(0).cast("long"), lambda s, x: s + x),
        ),
    )
    kind = "array<struct<filter_order:string,step:int,filter:int,path:array<int>,alone:int,last:int>>"
    each = weighed.select("part", "total", "edges", "sums", F.inline(constant(lattice.steps(), kind)))
    edge = lambda at: F.get("edges", at)
    here = edge(F.element_at("path", -1))
    gone = F.aggregate(F.transform("path", lambda at: edge(at)["n"]), F.lit(0).cast("long"), lambda s, x: s + x)
    return each.select(
        "part", "filter_order", "step",
        (F.col("total") - gone).alias("kept"),
        here["n"].alias("removed"),
        (edge(F.col("alone"))["n"] - here["n"]).alias("redundant"),
        edge(F.col("last"))["n"].alias("unique_fails"),
        here["good"].alias("good_lost"),
        here["toxic"].alias("toxic_lost"),
        F.get("sums", F.col("filter")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES["op12_filter_audit"] = op12_filter_audit

# Every order spelled out and every document's first failed step looked up in it.
ORACLES["op12_filter_audit"] = rf"""
WITH clean AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM clean GROUP BY t),
flags AS (
  SELECT c.doc_id, part,
         (CASE WHEN len(w) < {MIN_WORDS} THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(c.t, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(c.t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(c.t, '{SYMBOLS}') THEN 'D' ELSE '' END)
         || (CASE WHEN c.doc_id > least THEN 'E' ELSE '' END) AS failed
  FROM clean c JOIN firsts f ON c.t = f.t),
known AS (
  SELECT doc_id, max((quality = 1)::BIGINT) AS good, max((toxic = 1)::BIGINT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
rows AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flags d LEFT JOIN known k ON d.doc_id = k.doc_id GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (
  SELECT part, filter_order, s::INT AS step, substr(filter_order, s, 1) AS f, left(filter_order, s - 1) AS before
  FROM orders, generate_series(1, 5) g(s), (SELECT DISTINCT part FROM rows)),
seen AS (
  SELECT s.part, filter_order, step, f,
         sum(CASE WHEN translate(failed, before || f, '') = failed THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') <> failed THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM steps s JOIN rows r ON s.part = r.part GROUP BY s.part, filter_order, step, f),
sums AS (SELECT part, f, sum(removed)::BIGINT AS shapley FROM seen GROUP BY part, f)
SELECT s.part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
FROM seen s JOIN sums u ON s.part = u.part AND s.f = u.f"""
