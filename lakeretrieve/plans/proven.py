"""Exact search on a cell index that stops when no unread cell can matter.

Every cell has a centre and a radius, the greatest distance of one of its rows
from the centre. By the triangle inequality no row of a cell is nearer to a
query than the query's distance from the centre less the radius. A search
reads each query's cells in the order of that bound, a few in the first round and more
in each later one, until the k-th row found is nearer than the bound of the
next cell, or all cells are read. Conditions on promoted columns are filters of the
scan, and only found rows that meet them count, so a rare condition just takes
more rounds. Distances are those of plain search.

Cosine distance is half the squared distance of unit vectors, so its bounds are
taken there. A vector without direction is in no cell under cosine.

Centres travel to every task; their number is bounded by ``cells.CENTRE_BYTES``.
Rounds grow by a factor, so there are about as many as the logarithm of the
number of cells; what they found is stored between them, one table of ``k`` rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.metadata import promoted_filter
from lakeretrieve.plans.neighbours import nearest
from lakeretrieve.plans.topk import top_per_group
from lakeretrieve.session import materialise

# Cells of a query in the first round, and the factor of later rounds.
FIRST_CELLS = 4
GROWTH = 4
# Relative rounding that a bound gives away.
SLACK = 1e-9


def _space(metric: str) -> str:
    return "l1" if V.metric_kind(metric) == "l1" else "l2"


def with_radii(assigned: DataFrame, centres: DataFrame, metric: str = "cosine") -> DataFrame:
    """``centres (id, vector)`` with the ``radius`` and number of ``rows`` of their cells."""
    vector = F.col("embedding").cast("array<double>")
    if V.metric_kind(metric) == "cosine":
        vector = F.transform(vector, lambda x: x / V.norm(F.col("embedding")))
    centre = centres.select(F.col("id").alias("centre"), F.col("vector").alias("middle"))
    away = V.distance(_space(metric), vector, F.col("middle"))
    sizes = (
        assigned.select("cell", "embedding")
        .join(F.broadcast(centre), F.col("cell") == F.col("centre"))
        .groupBy(F.col("cell").alias("of"))
        .agg(F.max(away).alias("radius"), F.count(F.lit(1)).alias("rows"))
    )
    plain = centres.select("id", "vector")
    return plain.join(sizes, F.col("id") == F.col("of"), "left").select(
        "id", "vector", F.coalesce("radius", F.lit(0.0)).alias("radius"), F.coalesce("rows", F.lit(0)).alias("rows")
    )


def _bounds(query: np.ndarray, centres: np.ndarray, radii: np.ndarray, kind: str) -> np.ndarray:
    """No row of a cell is nearer to the query than this, in the metric's own distance."""
    if kind == "cosine":
        query = query / np.linalg.norm(query)
    apart = np.abs(centres - query).sum(axis=1) if kind == "l1" else np.sqrt(((centres - query) ** 2).sum(axis=1))
    bound = np.maximum(apart - radii - SLACK * (1 + apart + radii), 0.0)
    return bound * bound / 2 if kind == "cosine" else bound


def _planned(open_: DataFrame, cells: tuple, kind: str, first: int, width: int, below: float | None) -> DataFrame:
    """Open queries with their ``kth`` distance, the ``cells`` of a round and the bound of the ``next`` one, null if none can matter."""
    numbers, centres, radii = cells
    out = T.StructType(
        [open_.schema["qid"], T.StructField("qvector", T.ArrayType(T.DoubleType())), T.StructField("kth", T.DoubleType()), T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("next", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, following = [], []
            for vector, kth in zip(batch.column("qvector").to_pylist(), batch.column("kth").to_pylist()):
                query = np.asarray(vector, np.float64)
                if len(query) != centres.shape[1] or kind == "cosine" and not query.any():
                    chosen.append([])
                    following.append(None)
                    continue
                bound = _bounds(query, centres, radii, kind)
                order = np.argsort(bound, kind="stable")
                limit = min(x for x in (kth, below, np.inf) if x is not None)
                end = int(np.searchsorted(bound[order], limit, side="right"))
                chosen.append(numbers[order[first : min(end, first + width)]].tolist())
                following.append(float(bound[order[first + width]]) if first + width < end else None)
            columns = [batch.column("qid"), batch.column("qvector"), batch.column("kth"), pa.array(chosen, pa.list_(pa.int32())), pa.array(following, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return open_.select("qid", F.col("qvector").cast("array<double>").alias("qvector"), "kth").mapInArrow(run, out)


def nearest_proven(
    index: DataFrame,
    centres: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    *,
    conditions: dict | None = None,
    below: float | None = None,
    first_cells: int = FIRST_CELLS,
    growth: int = GROWTH,
) -> DataFrame:
    """``(qid, rank, id, distance)``, the same rows as an exact search of the indexed rows.

    ``index`` has ``id, embedding, cell`` and promoted columns, ``centres`` is
    what :func:`with_radii` gives. ``below`` keeps distances under a threshold,
    which also bounds the cells read. A query without vector or direction, or of another length, finds nothing.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    kind = V.metric_kind(metric)
    kept = index.filter(promoted_filter(index, conditions)) if conditions else index
    rows = kept.select("id", F.col("embedding").alias("vector"), "cell")
    held = centres.filter("rows > 0").select("id", "vector", "radius").orderBy("id").toArrow().to_pydict()
    middles = np.array(held["vector"], np.float64) if held["id"] else np.zeros((0, 0))
    cells = (np.array(held["id"], np.int32), middles, np.array(held["radius"], np.float64))

    asked = queries.select("qid", "qvector").filter(F.col("qvector").isNotNull()).withColumn("kth", F.lit(None).cast("double"))
    open_, found, first, width = asked, None, 0, first_cells
    while True:
        planned = materialise(_planned(open_, cells, kind, first, width, below), "planned")
        reading = planned.filter(F.size("cells") > 0)
        probes = reading.select("qid", F.explode("cells").alias("cell"))
        # What was found so far bounds what the tasks of this round emit.
        hits = nearest(rows, reading.select("qid", "qvector", "kth"), k, metric, below=below, probes=probes, within="kth").select("qid", "id", "distance")
        both = hits if found is None else found.unionByName(hits)
        best = top_per_group(both, ["qid"], [F.col("distance"), F.col("id")], k)
        found = materialise(best.select("qid", "id", "distance"), "found")
        full = found.groupBy(F.col("qid").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("kth")).filter(F.col("n") == k)
        left = planned.filter(F.col("next").isNotNull()).drop("kth").join(full, F.col("qid").eqNullSafe(F.col("of")), "left")
        open_ = materialise(left.filter(F.col("kth").isNull() | (F.col("kth") >= F.col("next"))).select("qid", "qvector", "kth"), "open")
        if open_.isEmpty():
            break
        first, width = first + width, width * growth
    return top_per_group(found, ["qid"], [F.col("distance"), F.col("id")], k).select("qid", "rank", "id", "distance")
