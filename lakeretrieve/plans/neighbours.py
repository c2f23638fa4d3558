"""Nearest neighbours of a table of queries, exact or within probed cells.

The work is |queries| x |corpus| distances, so it is laid out as blocked matrix
products: a task streams corpus vectors past a block of queries and emits at
most k candidates per query. No pair ever becomes a row.

Two layouts give the same rows:

* ``broadcast`` - the query block is measured first and shipped only if it
  fits a byte bound; the corpus is then scanned once, without a shuffle, and
  its splits follow file sizes, so no cell or copy group can overload a task.
* ``tiles`` - for query tables beyond the bound. Both sides are hashed into
  tiles of bounded size and each (corpus tile, query tile) pair is one task.

Where the candidates of all tasks would be many, a first pass over a sample
finds a distance that each query's k-th neighbour cannot exceed; the full pass
then emits only rows within it. The result does not depend on the sample.

Distances are compared in double precision, cosine distances at 12 decimals
(their rounding error is absolute); ties go to the smaller id. Vectors without
a defined distance (null, null element, wrong length, zero norm under cosine)
are nobody's neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakeretrieve.functions.vectors import metric_kind
from lakeretrieve.plans.spread import input_bytes, scan_splits, spread
from lakeretrieve.plans.topk import top_per_group

# Largest query block shipped to every executor, and rows per tile beyond it.
BROADCAST_BYTES = 64 << 20
TILE_ROWS = 50_000
# Candidate rows (tasks x queries x k) from which the first pass pays off, and
# the corpus rows it looks at.
MANY_CANDIDATES = 50_000_000
SAMPLE_ROWS = 1_000_000
# Distances that a task of the broadcast layout measures, about.
TASK_DISTANCES = 64_000_000
# Distances held at once by a task.
_BLOCK_CELLS = 2 << 20
_BLOCK_ROWS = 2048


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array as a double matrix; a null element becomes NaN."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def _prepare(matrix: np.ndarray, kind: str) -> np.ndarray:
    if kind != "cosine":
        return matrix
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0.0, np.nan, length)


def _distances(kind: str, queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    if kind == "cosine":
        return np.round(np.maximum(0.0, 1.0 - queries @ block.T), 12)
    out = np.empty((len(queries), len(block)))
    diff = np.empty_like(block)
    for i, query in enumerate(queries):
        np.subtract(block, query, out=diff)
        # In place: a fresh array of this size is paged in anew each time.
        if kind == "l2":
            np.multiply(diff, diff, out=diff)
        else:
            np.abs(diff, out=diff)
        diff.sum(axis=1, out=out[i])
    return np.sqrt(out, out=out) if kind == "l2" else out


def _place_in_run(sorted_keys: np.ndarray) -> np.ndarray:
    """Position of each entry within its run of equal keys."""
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return np.arange(len(sorted_keys)) - np.repeat(starts, np.diff(np.r_[starts, len(sorted_keys)]))


def _without_surplus_copies(ids: np.ndarray, block: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Drop copies of a vector beyond the k smallest ids.

    All copies are equally far from any query, so with ties going to the
    smaller id the others can never be among the k best.
    """
    bits = np.ascontiguousarray(block).view(np.uint64)
    weights = np.arange(1, 2 * block.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    digest = (bits * weights).sum(axis=1, dtype=np.uint64)
    values, first, counts = np.unique(digest, return_index=True, return_counts=True)
    if counts.max(initial=0) <= k:
        return ids, block
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], digest))
    surplus = order[_place_in_run(digest[order]) >= k]
    sample = first[np.searchsorted(values, digest[surplus])]
    surplus = surplus[(bits[surplus] == bits[sample]).all(axis=1)]
    # A digest clash would make a group look larger than it is: keep it whole.
    clashing = digest[(bits != bits[first[np.searchsorted(values, digest)]]).any(axis=1)]
    surplus = surplus[~np.isin(digest[surplus], clashing)]
    keep = np.ones(len(ids), dtype=bool)
    keep[surplus] = False
    return ids[keep], block[keep]


class _Best:
    """Running k best (distance, id) pairs of each query of a block."""

    def __init__(self, bound: np.ndarray, k: int, below: float | None):
        self.k = k
        self.below = below
        self.bound = np.where(np.isnan(bound), np.inf, bound)
        self.query = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.ids: np.ndarray | None = None

    def offer(self, distances: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> None:
        if self.below is not None:
            distances[~(distances < self.below)] = np.nan
        bound = self.bound[queries]
        # Where few rows are within the bounds found so far, those are all that is looked at.
        if distances.shape[1] > self.k and np.count_nonzero(distances <= bound[:, None]) > self.k * len(queries):
            kth = np.partition(distances, self.k - 1, axis=1)[:, self.k - 1]
            bound = np.fmin(bound, kth)
        # NaN compares false, so undefined distances never enter.
        row, col = np.nonzero(distances <= bound[:, None])
        if not len(row):
            return
        entering = ids[col]
        if self.ids is None:
            self.ids = entering[:0]
        # Only the queries that something enters are sorted again, not all of the task.
        touched = np.zeros(len(self.bound), dtype=bool)
        touched[queries[row]] = True
        again = touched[self.query]
        query = np.concatenate([self.query[again], queries[row]])
        distance = np.concatenate([self.distance[again], distances[row, col]])
        some_ids = np.concatenate([self.ids[again], entering])
        order = np.lexsort((np.unique(some_ids, return_inverse=True)[1], distance, query))
        place = _place_in_run(query[order])
        last = order[place == self.k - 1]
        self.bound[query[last]] = distance[last]
        order = order[place < self.k]
        self.query = np.concatenate([self.query[~again], query[order]])
        self.distance = np.concatenate([self.distance[~again], distance[order]])
        self.ids = np.concatenate([self.ids[~again], some_ids[order]])


def _scan(
    batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]],
    queries: np.ndarray,
    bound: np.ndarray,
    kind: str,
    k: int,
    below: float | None,
    probes: dict[int, np.ndarray] | None,
) -> _Best:
    """k best of every query over (ids, vectors, cells) batches."""
    best = _Best(bound, k, below)
    prepared = _prepare(queries, kind)
    step = max(1, _BLOCK_CELLS // _BLOCK_ROWS)
    everyone = np.arange(len(queries))

    def consider(ids: np.ndarray, matrix: np.ndarray, asking: np.ndarray) -> None:
        for start in range(0, len(ids), _BLOCK_ROWS):
            part_ids, block = _without_surplus_copies(
                ids[start:start + _BLOCK_ROWS], matrix[start:start + _BLOCK_ROWS], k
            )
            block = _prepare(block, kind)
            for q in range(0, len(asking), step):
                some = asking[q:q + step]
                best.offer(_distances(kind, prepared[some], block), part_ids, some)

    for ids, matrix, cells in batches:
        if probes is None:
            consider(ids, matrix, everyone)
            continue
        for cell in np.unique(cells):
            asking = probes.get(int(cell))
            if asking is not None:
                inside = cells == cell
                consider(ids[inside], matrix[inside], asking)
    return best


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _result(best: _Best, qids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch | None:
    if best.ids is None:
        return None
    columns = [qids[best.query], best.ids, best.distance]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _query_block(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, vectors and bounds of a table ``qid, qvector, bound``."""
    vectors = [_matrix(c, dim) for c in table.column("qvector").chunks]
    matrix = np.concatenate([np.empty((0, dim)), *vectors])
    return _ids(table.column("qid")), matrix, _ids(table.column("bound")).astype(np.float64)


def _may_be_much(corpus: DataFrame, n_queries: int) -> bool:
    """Whether the distances could be more than ``TASK_DISTANCES`` a core; a row has four bytes or more."""
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    return n_queries * (input_bytes(corpus) // 4) > TASK_DISTANCES * cores


def _spread_by_work(corpus: DataFrame, tasks: int) -> DataFrame:
    """Round-robin over ``tasks`` if neither the scan nor the cores give as many."""
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    return corpus.repartition(tasks) if tasks > max(cores, scan_splits(corpus)) else spread(corpus)


def _broadcast_layout(corpus, queries, probes, dim, kind, k, below, out: T.StructType) -> DataFrame:
    spark = corpus.sparkSession
    # Bounded: the caller measured this table against BROADCAST_BYTES.
    qids, matrix, bound = _query_block(queries.toArrow(), dim)
    asking = None
    if probes is not None:
        place = {qid: i for i, qid in enumerate(qids.tolist())}
        asking = {}
        # A cell's queries come together: as many rows as there are probed cells.
        for cell, members in probes.groupBy("cell").agg(F.collect_list("qid")).toLocalIterator():
            asking[cell] = np.array(sorted(place[qid] for qid in members))
        # Only probed cells are read: a partition filter on the cell table.
        corpus = corpus.filter(F.col("cell").isin(sorted(asking)))
    shipped = spark.sparkContext.broadcast((qids, matrix, bound, asking))
    arrow_out = _arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors, bounds, wanted = shipped.value
        rows = (
            (_ids(b.column(0)), _matrix(b.column(1), dim), None if wanted is None else _ids(b.column(2)))
            for b in batches
        )
        found = _result(_scan(rows, vectors, bounds, kind, k, below, wanted), names, arrow_out)
        if found is not None:
            yield found

    return corpus.mapInArrow(scan, out)


def _tile_layout(corpus, queries, probes, n_queries, dim, kind, k, below, out, tile_rows) -> DataFrame:
    """Bounded (corpus tile, query tile) pairs; cells larger than a tile split."""
    query_tiles = max(1, -(-n_queries // tile_rows))
    if probes is None:
        splits = F.lit(max(1, -(-corpus.count() // tile_rows)))
        rows = corpus.withColumn("cell", F.lit(0)).withColumn("__splits", splits)
        asked = queries.withColumn("cell", F.lit(0)).withColumn("__splits", splits)
    else:
        sizes = corpus.groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias("__splits")
        )
        rows = corpus.join(sizes, "cell")
        asked = queries.join(probes, "qid", "inner").join(sizes, "cell")
    left = (
        # The vector takes part in the hash so that rows sharing an id spread.
        rows.withColumn("__split", F.pmod(F.xxhash64("id", "vector"), F.col("__splits")).cast("int"))
        .withColumn("__tile", F.explode(F.sequence(F.lit(0), F.lit(query_tiles - 1))))
        .select("cell", "__split", "__tile", "id", "vector")
    )
    right = (
        asked.withColumn("__split", F.explode(F.sequence(F.lit(0), F.col("__splits") - 1)))
        .withColumn("__tile", F.pmod(F.xxhash64("qid"), F.lit(query_tiles)).cast("int"))
        .select("cell", "__split", "__tile", "qid", "qvector", "bound")
    )
    keys = ["cell", "__split", "__tile"]
    arrow_out = _arrow_schema(out)

    def pair(rows: pa.Table, asking: pa.Table) -> pa.Table:
        if not rows.num_rows or not asking.num_rows:
            return arrow_out.empty_table()
        names, vectors, bounds = _query_block(asking, dim)
        batches = (
            (_ids(b.column("id")), _matrix(b.column("vector"), dim), None) for b in rows.to_batches()
        )
        found = _result(_scan(batches, vectors, bounds, kind, k, below, None), names, arrow_out)
        return arrow_out.empty_table() if found is None else pa.Table.from_batches([found])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, out)


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    *,
    below: float | None = None,
    probes: DataFrame | None = None,
    within: str | None = None,
    layout: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    tile_rows: int = TILE_ROWS,
    many_candidates: int = MANY_CANDIDATES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``(qid, rank, id, distance)``: the k nearest corpus rows of each query.

    ``corpus`` has ``id, vector`` (and ``cell`` when ``probes (qid, cell)`` is
    given), ``queries`` has ``qid, qvector``. ``below`` keeps distances under a
    threshold. ``within`` names a column of the queries: a distance beyond which the caller needs no
    neighbours, or null; tasks emit no candidates beyond it. One job first measures the number and length of the queries.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if layout not in ("auto", "broadcast", "tiles"):
        raise ValueError(f"unknown layout: {layout}")
    kind = metric_kind(metric)
    # The slack covers rounding between two passes.
    slack = lambda x: x * (1 + 1e-9) + 1e-9
    known = F.lit(None).cast("double") if within is None else slack(F.col(within))
    unbounded = queries.select("qid", "qvector", known.alias("bound")).filter(F.col("qvector").isNotNull())
    queries = unbounded.select("qid", "qvector")
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("qvector")).alias("low"), F.max(F.size("qvector")).alias("high")
    ).first()
    if size["n"] and size["low"] != size["high"]:
        raise ValueError(f"query vectors have different lengths: {size['low']} to {size['high']}")
    dim = size["high"] or 1
    out = T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    columns = ["id", "vector"] + (["cell"] if probes is not None else [])
    usable = corpus.select(*columns).filter(F.size("vector") == dim)
    if layout == "auto":
        layout = "broadcast" if size["n"] * (dim + 16) * 8 <= broadcast_bytes else "tiles"

    def search(rows: DataFrame, asked: DataFrame) -> DataFrame:
        if layout == "broadcast":
            found = _broadcast_layout(_spread_by_work(rows, dealt), asked, probes, dim, kind, k, below, out)
        else:
            found = _tile_layout(rows, asked, probes, size["n"], dim, kind, k, below, out, tile_rows)
        return top_per_group(found, ["qid"], [F.col("distance"), F.col("id")], k)

    # Every query meets every row where there are no probes, so the work grows with their product.
    counted = layout == "broadcast" and probes is None and _may_be_much(usable, size["n"])
    total = usable.count() if counted else None
    dealt = -(-total * size["n"] // TASK_DISTANCES) if counted else 0
    tasks = max(scan_splits(usable), dealt) if layout == "broadcast" else None
    if probes is None and within is None:
        # Every task may emit k rows of every query.
        if total is None and (tasks is None or tasks * size["n"] * k > many_candidates):
            total = usable.count()
        if tasks is None:
            tasks = -(-total // tile_rows)
        if tasks * size["n"] * k > many_candidates and total > 2 * sample_rows:
            first = search(usable.sample(sample_rows / total, seed=1), unbounded)
            limits = first.groupBy("qid").agg(
                F.count(F.lit(1)).alias("n"),
                slack(F.max("distance")).alias("bound"),
            )
            limits = limits.filter(F.col("n") == k).select("qid", "bound")
            unbounded = queries.join(limits, "qid", "left")
    return search(usable, unbounded).select("qid", "rank", "id", "distance")
