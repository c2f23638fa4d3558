"""Vector index: rows grouped into cells around k-means centres.

The index is an ordinary table partitioned by ``cell``. A search reads only the
cells nearest to each query and ranks their rows exactly.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from lakeretrieve.functions.vectors import metric_kind
from lakeretrieve.plans.neighbours import nearest

# Training rows per centre: centres settle long before the corpus is used up.
SAMPLE_PER_CELL = 256
# The centres travel to every task, so their number is bounded by their size.
CENTRE_BYTES = 64 << 20
# Rows per file of a cell, so that a large cell is many scan splits.
ROWS_PER_FILE = 100_000


def index_name(table: str, prefix: str = "cells") -> str:
    """Name of a table's index: prefix and 8 hex digits of the name's MD5."""
    return f"{prefix}_{hashlib.md5(table.encode()).hexdigest()[:8]}"


def train_centres(corpus: DataFrame, cells: int | None = None, metric: str = "cosine", seed: int = 42) -> KMeansModel:
    """k-means on a bounded sample; only the centres come from the sample."""
    rows = corpus.select("embedding").filter(F.col("embedding").isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    total = size["n"]
    cells = cells or max(1, min(int(math.sqrt(total)), CENTRE_BYTES // (8 * (size["dim"] or 1))))
    fraction = min(1.0, 1.2 * cells * SAMPLE_PER_CELL / max(total, 1))
    sample = rows if fraction >= 1.0 else rows.sample(fraction, seed=seed)
    kmeans = KMeans(
        k=cells,
        seed=seed,
        maxIter=10,
        featuresCol="features",
        predictionCol="cell",
        distanceMeasure="cosine" if metric_kind(metric) == "cosine" else "euclidean",
    )
    return kmeans.fit(_features(sample, kmeans.getDistanceMeasure()))


def _features(df: DataFrame, measure: str) -> DataFrame:
    # A zero vector has no direction; cosine k-means rejects it. It has distances like any other.
    usable = F.exists("embedding", lambda x: x != 0) if measure == "cosine" else F.col("embedding").isNotNull()
    return df.filter(usable).withColumn(
        "features", array_to_vector(F.col("embedding").cast("array<double>"))
    )


def assign_cells(corpus: DataFrame, model: KMeansModel) -> DataFrame:
    """Every row with the number of its nearest centre."""
    return model.transform(_features(corpus, model.getDistanceMeasure())).drop("features")


def assign_to_centres(corpus: DataFrame, centres: DataFrame, metric: str = "cosine") -> DataFrame:
    """Rows with the number of their nearest stored centre."""
    ranking = "cosine" if metric_kind(metric) == "cosine" else "l2"
    asked = corpus.select(F.col("id").alias("qid"), F.col("embedding").alias("qvector"))
    cell = nearest(centres, asked, 1, ranking).select(F.col("qid").alias("id"), F.col("id").alias("cell"))
    return corpus.join(cell.distinct(), "id")


def centre_table(spark, model: KMeansModel) -> DataFrame:
    """``(id, vector)`` of the centres; as many rows as there are cells."""
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "id int, vector array<double>")


def write_index(assigned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store assigned rows by cell. A large cell is split into many files.

    Rows go to (cell, slice of the id), so no task writes a whole hot cell.
    """
    slices = 16
    (
        assigned.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(slices)))
        .write.mode(mode)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("cell")
        .parquet(path)
    )


def search_cells(
    index: DataFrame,
    centres: DataFrame,
    queries: DataFrame,
    k: int = 4,
    nprobe: int = 8,
    metric: str = "cosine",
    **layout,
) -> DataFrame:
    """``(qid, rank, id, distance)`` among the ``nprobe`` nearest cells.

    Approximate by nature: a neighbour in a cell that is not probed is missed.
    With ``nprobe`` = number of cells the result equals the exact search.
    """
    ranking = "cosine" if metric_kind(metric) == "cosine" else "l2"
    probes = nearest(centres, queries, nprobe, ranking).select("qid", F.col("id").alias("cell"))
    rows = index.select("id", F.col("embedding").alias("vector"), "cell")
    return nearest(rows, queries, k, metric, probes=probes, **layout)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that an index search found."""
    wanted = exact.select("qid", "id")
    hit = found.select("qid", "id", F.lit(1).alias("hit"))
    return wanted.join(hit, ["qid", "id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
