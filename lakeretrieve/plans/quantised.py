"""Quantised vector index: two levels of centres, and product codes of what is left of a vector.

Coarse centres divide the corpus; inside each, fine centres are trained by its own
task, so that a row is compared with the coarse centres and the fine ones of one
of them only. What remains of a vector after its fine centre is cut into
subspaces, each coded by the nearest of ``CENTROIDS`` centroids in one byte. One of
them is zero, so a coded vector is never farther from its row than the centre is.

A search reads the codes of the probed cells: a table of distances from the
query to each centroid turns a code into a distance by adding one number a
subspace. The best rows by code are fetched by row number and ranked exactly.

Training looks at a bounded number of rows a centre (``SAMPLE_PER_CENTRE``,
chosen by hash); every row is assigned and coded. Models are bounded by
``cells.CENTRE_BYTES`` and travel to the tasks. Metrics are cosine and l2; under
cosine vectors are scaled to unit length and those without direction left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakeretrieve.functions import vectors as V
from lakeretrieve.plans import cells
from lakeretrieve.plans.neighbours import BROADCAST_BYTES, _Best, _matrix
from lakeretrieve.plans.topk import top_per_group
from lakeretrieve.session import materialise

CENTROIDS = 256
SUBSPACES = 16
SAMPLE_PER_CENTRE = 256
ROUNDS = 12
# Rows by code that are ranked exactly, for each row wanted.
RERANKED = 8
BLOCK_ROWS = 4096


def _lloyd(points: np.ndarray, k: int, seed: int, zero: bool = False) -> np.ndarray:
    """At most k means of some points; with ``zero`` the first one stays at the origin."""
    distinct = np.unique(points, axis=0)
    k = max(1, min(k, len(distinct) + zero))
    middles = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]].copy()
    if zero:
        middles = np.concatenate([np.zeros((1, points.shape[1])), middles[: k - 1]])
    for _ in range(ROUNDS):
        nearest = _nearest(points, middles)
        for i in range(int(zero), len(middles)):
            inside = points[nearest == i]
            if len(inside):
                middles[i] = inside.mean(axis=0)
    return middles


def _nearest(points: np.ndarray, middles: np.ndarray) -> np.ndarray:
    found = [
        ((middles**2).sum(axis=1) - 2 * points[at : at + BLOCK_ROWS] @ middles.T).argmin(axis=1)
        for at in range(0, len(points), BLOCK_ROWS)
    ]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Fine centres ordered by their coarse one, where each coarse one's begin, and a codebook a subspace."""

    metric: str
    coarse: np.ndarray
    centres: np.ndarray
    begins: np.ndarray
    books: np.ndarray

    def cells_of(self, points: np.ndarray) -> np.ndarray:
        """The fine cell of each point: its nearest coarse centre's nearest fine centre."""
        over = _nearest(points, self.coarse)
        found = np.empty(len(points), np.int64)
        for c in np.unique(over):
            inside = over == c
            found[inside] = self.begins[c] + _nearest(points[inside], self.centres[self.begins[c] : self.begins[c + 1]])
        return found

    def codes(self, left: np.ndarray) -> np.ndarray:
        parts = np.split(left, len(self.books), axis=1)
        return np.stack([_nearest(p, b) for p, b in zip(parts, self.books)], axis=1).astype(np.uint8)

    def decoded(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centres[numbers] + np.concatenate([b[codes[:, j]] for j, b in enumerate(self.books)], axis=1)


def _usable(corpus: DataFrame, metric: str) -> DataFrame:
    """Rows with a vector that has a place; ``point`` is the vector in the space of the index."""
    kind = V.metric_kind(metric)
    if kind == "l1":
        raise ValueError("product codes add squared distances, so the metric is cosine or l2")
    vector = F.col("embedding").cast("array<double>")
    rows = corpus.filter(F.col("embedding").isNotNull())
    if kind == "cosine":
        rows = rows.filter(F.exists("embedding", lambda x: x != 0))
        vector = F.transform(vector, lambda x: x / V.norm(F.col("embedding")))
    return rows.withColumn("point", vector)


def train(corpus: DataFrame, n_cells: int | None = None, metric: str = "cosine", subspaces: int = SUBSPACES, seed: int = 42) -> Model:
    """Centres and codebooks. The driver sees models only, never rows."""
    rows = _usable(corpus, metric).select(F.col("point").alias("embedding"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim"), F.approx_count_distinct("embedding").alias("different")).first()
    total, dim = size["n"], size["dim"] or subspaces
    if dim % subspaces:
        raise ValueError(f"{dim} dimensions do not divide into {subspaces} subspaces")
    if not total:
        empty = np.zeros((1, dim))
        return Model(metric, empty, empty, np.array([0, 1]), np.zeros((subspaces, 1, dim // subspaces)))
    wanted = n_cells or max(1, min(int(math.sqrt(total)), cells.CENTRE_BYTES // (8 * dim)))
    n_coarse = min(math.isqrt(wanted), size["different"] // 2)
    if n_coarse < 2:
        coarse, by_coarse = np.zeros((1, dim)), rows.withColumn("cell", F.lit(0))
    else:
        over = cells.train_centres(rows, n_coarse, "l2", seed)
        coarse, by_coarse = np.array(list(over.clusterCenters()), np.float64), cells.assign_cells(rows, over)
    counts = {r["cell"]: r["count"] for r in by_coarse.groupBy("cell").count().collect()}
    share = {c: max(1, round(wanted * n / total)) for c, n in counts.items()}
    limit = SAMPLE_PER_CENTRE * max(share.values())
    chosen = top_per_group(by_coarse.withColumn("at", F.xxhash64("embedding")), ["cell"], [F.col("at")], limit)

    def fine(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        middles = _lloyd(np.stack(part["embedding"]), share[key[0]], seed)
        return pd.DataFrame({"cell": key[0], "vector": list(middles)})

    found = chosen.select("cell", "embedding").groupBy("cell").applyInPandas(fine, "cell int, vector array<double>").toPandas()
    own = {c: np.stack(part["vector"]) for c, part in found.groupby("cell")}
    # A coarse centre whose cell is empty is its own fine centre.
    each = [own.get(c, coarse[c : c + 1]) for c in range(len(coarse))]
    begins = np.concatenate([[0], np.cumsum([len(e) for e in each])])
    plain = Model(metric, coarse, np.concatenate(each), begins, np.zeros((subspaces, 1, dim // subspaces)))

    rate = min(1.0, CENTROIDS * SAMPLE_PER_CENTRE / total)
    within = F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) < int(rate * 1_000_000) + 1
    shipped = corpus.sparkSession.sparkContext.broadcast(plain)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("embedding"), dim)
            left = points - shipped.value.centres[shipped.value.cells_of(points)]
            cut = np.stack(np.split(left, subspaces, axis=1), axis=1).reshape(-1, dim // subspaces)
            numbers = np.tile(np.arange(subspaces, dtype=np.int32), len(points))
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(list(cut), pa.list_(pa.float64()))], ["part", "piece"])

    def book(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": key[0], "vector": list(_lloyd(np.stack(part["piece"]), CENTROIDS, seed, zero=True))})

    pieces = rows.filter(within).mapInArrow(parts, "part int, piece array<double>")
    books = pieces.groupBy("part").applyInPandas(book, "part int, vector array<double>").toPandas()
    made = {p: np.stack(b["vector"]) for p, b in books.groupby("part")}
    longest = max(map(len, made.values()))
    # Books of fewer centroids repeat their zero.
    full = [np.concatenate([b, np.zeros((longest - len(b), b.shape[1]))]) for _, b in sorted(made.items())]
    return Model(metric, coarse, np.concatenate(each), begins, np.stack(full))


def coded(corpus: DataFrame, model: Model) -> DataFrame:
    """``id, row, embedding, cell, code`` of every row; ``row`` tells rows of equal ids apart."""
    shipped = corpus.sparkSession.sparkContext.broadcast(model)
    dim = model.centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("point"), dim)
            numbers = shipped.value.cells_of(points)
            codes = shipped.value.codes(points - shipped.value.centres[numbers])
            columns = [batch.column(c) for c in ("id", "row", "embedding")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(numbers.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())],
                ["id", "row", "embedding", "cell", "code"],
            )

    rows = _usable(corpus, model.metric).select("id", F.monotonically_increasing_id().alias("row"), "embedding", "point")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"id {kinds['id']}, row long, embedding {kinds['embedding']}, cell int, code binary")


def write(corpus: DataFrame, model: Model, path: str) -> None:
    cells.write_index(coded(corpus, model), path)


def _by_code(index: DataFrame, model: Model, asked: pa.Table, nprobe: int, most: int, out: T.StructType) -> DataFrame:
    """``qid, row, near``: rows of the probed cells that are best by code, for a bounded block of queries."""
    spark, dim = index.sparkSession, model.centres.shape[1]
    qids = asked.column("qid").to_numpy(zero_copy_only=False)
    points = np.array(asked.column("point").to_pylist(), np.float64).reshape(-1, dim)
    asking: dict[int, list[int]] = {}
    for i, point in enumerate(points):
        away = ((model.centres - point) ** 2).sum(axis=1)
        for c in np.argsort(away, kind="stable")[:nprobe].tolist():
            asking.setdefault(c, []).append(i)
    shipped = spark.sparkContext.broadcast((model, qids, points, {c: np.array(q) for c, q in asking.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, vectors, wanted = shipped.value
        best = _Best(np.full(len(names), np.nan), most, None)
        for batch in batches:
            numbers, rows = batch.column("cell").to_numpy(), batch.column("row").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(rows), -1)
            for c in np.unique(numbers):
                inside = np.flatnonzero(numbers == c)
                some = wanted[int(c)]
                left = np.split(vectors[some] - held.centres[c], len(held.books), axis=1)
                tables = [((p[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) for p, b in zip(left, held.books)]
                for at in range(0, len(inside), BLOCK_ROWS):
                    part = inside[at : at + BLOCK_ROWS]
                    away = sum(t[:, codes[part, j]] for j, t in enumerate(tables))
                    best.offer(away, rows[part], some)
        if best.ids is not None:
            columns = [pa.array(names[best.query]), pa.array(best.ids), pa.array(best.distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["qid", "row", "near"])

    probed = index.filter(F.col("cell").isin(sorted(asking))).select("row", "code", "cell")
    return probed.mapInArrow(run, out)


def search(index: DataFrame, model: Model, queries: DataFrame, k: int = 4, nprobe: int = 8, reranked: int = RERANKED) -> DataFrame:
    """``(qid, rank, id, distance)``: the k nearest of the ``reranked * k`` rows of the probed cells that are best by code.

    Queries go in blocks of at most ``BROADCAST_BYTES``, each against one scan of the codes of its cells.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    dim = model.centres.shape[1]
    asked = materialise(
        _usable(queries.select("qid", F.col("qvector").alias("embedding")), model.metric).filter(F.size("point") == dim), "asked"
    )
    blocks = -(-asked.count() * 8 * (dim + nprobe + 2) // BROADCAST_BYTES) or 1
    out = T.StructType([asked.schema["qid"], T.StructField("row", T.LongType()), T.StructField("near", T.DoubleType())])
    found = None
    for block in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block).select("qid", "point").toArrow()
        best = _by_code(index, model, some, nprobe, reranked * k, out)
        found = best if found is None else found.unionByName(best)
    near = materialise(top_per_group(found, ["qid"], [F.col("near"), F.col("row")], reranked * k).select("qid", "row"), "by-code")
    exact = near.join(index.select("row", "id", "embedding"), "row").join(asked.select("qid", F.col("embedding").alias("qvector")), "qid")
    away = V.distance(model.metric, F.col("embedding"), F.col("qvector"))
    away = F.round(away, 12) if V.metric_kind(model.metric) == "cosine" else away
    return top_per_group(exact.withColumn("distance", away), ["qid"], [F.col("distance"), F.col("id")], k).select("qid", "rank", "id", "distance")
