"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeretrieve.llm.common import stored

# Links that one task writes to a file; a small table of links is not spread over as many files as there are partitions.
LINKS_PER_FILE = 1_000_000


def connected_components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root`` of every linked node; the root is the smallest node of its component.

    ``links`` has long columns ``a`` and ``b``. Stars are hooked in turn to the
    smallest neighbour of the larger side and of the smaller side until nothing
    changes, which takes about as many rounds as the logarithm of the longest
    path. Each round is a grouped minimum, combined before the shuffle, and a
    join back on it, and is stored so that no lineage grows. Nothing is
    collected but a count and a sum.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = (edges.count(),)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        hooked = large.join(low, F.col("u") == F.col("n"))
        small = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hooked.select("u", F.col("m").alias("v")))
        # A round makes at most twice the links it began with.
        files = max(1, -(-2 * before[0] // LINKS_PER_FILE))
        edges = stored(small.where("u <> v").distinct().coalesce(files), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are still changing after {rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
