"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Each text gets a 64-bit fingerprint of its word shingles. Two fingerprints are
linked at ``distance`` or fewer differing bits. Bits are grouped into
partitions so that correlated bits share one. For thresholds t_1 .. t_m, each
at least -1, that add up to ``distance - m + 1``, two linked fingerprints differ in at most
t_i bits of some partition i; the thresholds of a fingerprint are chosen by
dynamic programming on the number of candidates that each would bring, so
common values are not probed where rare ones are enough.

Equal fingerprints are one node. Nodes meet in buckets (partition, value); a
bucket beyond ``block`` nodes is split into blocks, and every pair of blocks is
a group of its own. A group reports a spanning star of each of its linked
sets, never its pairs, and no group is larger than two blocks.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero, linked like any other. Rows with equal ids are separate
rows with one id. Null ids have fingerprints and components too; they are
never the smallest id unless a component has no other. Columns named
like an output column are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import rows_kept, stored, unused, with_row_key
from lakeretrieve.llm.components import connected_components
from lakeretrieve.llm.registry import QUERIES, table

BITS = 64
DISTANCE = 3
SEED = 42
# Leading bits of a partition's value that candidate counts are kept for.
COUNTED = 12
# Nodes of a bucket that are compared in one group.
BLOCK = 1024
# Rows of shingle hashes unpacked to bits at a time.
CHUNK = 65536


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Hashes of all shingles; bytes.split and bytes.lower act on ASCII only. Fewer words than ``width`` are one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist())],
        np.uint64,
    )


def fingerprint(text: bytes | None, width: int) -> int:
    """Bitwise majority of the shingles' hashes."""
    hashes = shingles(text, width)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, width: int, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` without its text and with the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            prints = np.array([fingerprint(t, width) for t in rows["__text"]], np.uint64).view(np.int64)
            yield rows[kept].assign(**{out: prints})

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept], f"{out} long"])
    return docs.select(*kept, F.col(text).cast("binary").alias("__text")).mapInPandas(run, schema)


def _bit_rows(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_partitions(nodes: DataFrame, parts: int) -> list[list[int]]:
    """Bits grouped by correlation over all nodes, in ``parts`` groups of almost equal size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for rows in batches:
            for at in range(0, len(rows), CHUNK):
                bits = _bit_rows(rows["fp"].to_numpy()[at : at + CHUNK]).astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        if n:
            cells = np.append(both.ravel(), n).astype(np.int64)
            yield pd.DataFrame({"cell": np.arange(len(cells)), "n": cells})

    counts = nodes.select("fp").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1)
    for row in counts.collect():
        cells[row["cell"]] = row["n"]
    n = max(cells[-1], 1.0)
    both = cells[:-1].reshape(BITS, BITS) / n
    rate = np.diag(both)
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
    strength = np.abs((both - np.outer(rate, rate)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        first = max(sorted(free), key=lambda b: strength[b, sorted(free)].sum())
        group = [first]
        free.remove(first)
        while len(group) < width:
            nearest = max(sorted(free), key=lambda b: strength[b, group].sum())
            group.append(nearest)
            free.remove(nearest)
        groups.append(sorted(group))
    return groups


def parts_for(nodes: int) -> int:
    """Partitions so wide that a value is shared by few of the nodes; any number is exact."""
    return next((m for m in (4, 3) if 2 ** (BITS // m) >= 4 * nodes), 2)


def _values(prints: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a partition as a number, first bit lowest."""
    out = np.zeros(len(prints), np.int64)
    for k, bit in enumerate(group):
        out |= ((prints >> bit) & 1) << k
    return out


def _counted(width: int) -> int:
    return min(COUNTED, width)


@lru_cache(maxsize=None)
def _masks(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with exactly ``most`` ones."""
    return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), most)], np.int64)


def _estimates(histogram: np.ndarray, width: int, most: int) -> np.ndarray:
    """Expected candidates within each threshold from -1 to ``most``, by counted bits.

    The counted bits are known; the others are taken as evenly spread.
    """
    known = _counted(width)
    rest = width - known
    exact = np.stack([histogram[np.arange(1 << known)[:, None] ^ _masks(known, j)[None, :]].sum(axis=1) if j <= known else np.zeros(1 << known) for j in range(most + 1)])
    found = np.zeros((most + 2, 1 << known))
    for t in range(most + 1):
        for j in range(t + 1):
            reach = sum(math.comb(rest, r) for r in range(t - j + 1)) / 2**rest
            found[t + 1] += exact[j] * reach
        # Probing a value costs a row whether or not it meets a candidate.
        found[t + 1] += sum(math.comb(width, r) for r in range(t + 1))
    return found


def allocate(costs: list[np.ndarray], distance: int) -> np.ndarray:
    """Thresholds of least total cost that add up to ``distance - m + 1``.

    ``costs[i]`` has a row for each threshold from -1 to ``distance`` and a
    column for each fingerprint; the result has a row for each fingerprint.
    """
    m, n = len(costs), costs[0].shape[1]
    spent = distance + 1  # thresholds counted from -1 up: their sum is distance + 1
    best = np.full((spent + 1, n), np.inf)
    best[0] = 0
    choices = []
    for cost in costs:
        options = np.full((spent + 1, distance + 2, n), np.inf)
        for total in range(spent + 1):
            for t in range(min(total, distance + 1) + 1):
                options[total, t] = best[total - t] + cost[t]
        choice = options.argmin(axis=1)
        choices.append(choice)
        best = np.take_along_axis(options, choice[:, None, :], axis=1)[:, 0, :]
    thresholds = np.zeros((n, m), np.int64)
    total, each = np.full(n, spent), np.arange(n)
    for i in reversed(range(m)):
        thresholds[:, i] = choices[i][total, each]
        total = total - thresholds[:, i]
    return thresholds - 1


def bucket_rows(nodes: DataFrame, groups: list[list[int]], distance: int) -> DataFrame:
    """``key, fp, role``: where a node waits (1), probes (2), or both (3)."""
    m = len(groups)

    def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros(1 << _counted(len(g)), np.int64) for g in groups]
        for rows in batches:
            for i, g in enumerate(groups):
                sums[i] += np.bincount(_values(rows["fp"].to_numpy(), g) & ((1 << _counted(len(g))) - 1), minlength=len(sums[i]))
        for i, s in enumerate(sums):
            seen = np.flatnonzero(s)
            yield pd.DataFrame({"part": i, "value": seen, "n": s[seen]})

    sums = [np.zeros(1 << _counted(len(g))) for g in groups]
    schema = "part long, value long, n long"
    seen = nodes.select("fp").mapInPandas(histograms, schema).groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
    part, value, n = (seen[c].to_numpy() for c in ("part", "value", "n"))
    for i, s in enumerate(sums):
        s[value[part == i]] = n[part == i]
    estimates = [_estimates(s, len(g), distance) for s, g in zip(sums, groups)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            prints = rows["fp"].to_numpy()
            values = [_values(prints, g) for g in groups]
            low = [v & ((1 << _counted(len(g))) - 1) for v, g in zip(values, groups)]
            thresholds = allocate([e[:, v] for e, v in zip(estimates, low)], distance)
            for i, g in enumerate(groups):
                key = values[i] * m + i
                role = np.where(thresholds[:, i] >= 0, 3, 1)
                yield pd.DataFrame({"key": key, "fp": prints, "role": role})
                for t in range(1, distance + 1):
                    who = np.flatnonzero(thresholds[:, i] >= t)
                    masks = _masks(len(g), t)
                    for at in range(0, len(who), 4096):
                        some = who[at : at + 4096]
                        if len(some):
                            near = (values[i][some][:, None] ^ masks[None, :]).ravel() * m + i
                            yield pd.DataFrame({"key": near, "fp": np.repeat(prints[some], len(masks)), "role": 2})

    return nodes.select("fp").mapInPandas(run, "key long, fp long, role int")


def _stars(prints: np.ndarray, roles: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """A star over each linked set of a group: (member, its first member)."""
    n = len(prints)
    probes, waits = (roles & 2) > 0, (roles & 1) > 0
    unsigned = prints.view(np.uint64)
    open_ = np.ones(n, bool)
    for start in range(n):
        if not open_[start]:
            continue
        open_[start] = False
        frontier = [start]
        while frontier and open_.any():
            node = frontier.pop()
            left = np.flatnonzero(open_)
            near = np.bitwise_count(unsigned[left] ^ unsigned[node]) <= distance
            near &= (waits[left] if probes[node] else False) | (probes[left] if waits[node] else False)
            reached = left[near]
            open_[reached] = False
            frontier.extend(reached.tolist())
            for other in reached.tolist():
                if prints[other] != prints[start]:
                    yield int(prints[other]), int(prints[start])


def links(nodes: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that join the same sets of fingerprints as all links of ``distance`` would."""
    groups = bit_partitions(nodes, parts_for(nodes.count()))
    rows = stored(bucket_rows(nodes, groups, distance), "buckets")
    crowded = rows.groupBy("key").count().where(F.col("count") > block).select(
        F.col("key").alias("full"), F.ceil(F.col("count") / block).cast("int").alias("blocks")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    placed = rows.join(crowded, F.col("key") == F.col("full"), "left").select("key", "fp", "role", blocks.alias("blocks"), own.alias("own"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "role"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame()
        for rows in itertools.chain(batches, [None]):
            last = rows is None
            rows = rest if last else pd.concat([rest, rows]) if len(rest) else rows
            if not len(rows):
                continue
            columns = [rows[c].to_numpy() for c in ("key", "i", "j")]
            edge = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            bounds = [0, *edge.tolist(), *([len(rows)] if last else [])]
            prints, roles = rows["fp"].to_numpy(), rows["role"].to_numpy()
            found: list[tuple[int, int]] = []
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    found.extend(_stars(prints[a:b], roles[a:b], distance))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            rest = rows.iloc[bounds[-1] :]

    dealt = paired.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(run, "a long, b long")


def rooted(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, least, root`` for rows of ``doc_id, fp``, one row per fingerprint."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(nodes.select("fp"), distance))
    return stored(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted"
    )


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``print_fp, component_id`` for rows of ``doc_id, fp``, one row per fingerprint."""
    named = rooted(prints, distance)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    return named.join(smallest, F.col("root") == F.col("of")).select(F.col("fp").alias("print_fp"), "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    prints = stored(with_fingerprints(docs.select("doc_id", "text"), width), "prints")
    return prints.join(components(prints, distance), F.col("fp") == F.col("print_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, width: int = 5, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with its own columns: that of the smallest id, null ids last, of equal ids the first stored row."""
    key = unused("__row", docs)
    numbered = with_row_key(docs, key)
    rows = numbered.select("doc_id", F.col(key).alias("row"), "text")
    prints = stored(with_fingerprints(rows, width), "prints")
    named = rooted(prints.select("doc_id", "fp"), distance).select(F.col("fp").alias("print_fp"), "root")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    # Equal texts come down to one row before they meet their component.
    by_print = prints.groupBy("fp").agg(first)
    kept = by_print.join(named, F.col("fp") == F.col("print_fp")).groupBy("root").agg(F.min("first").alias("first"))
    return rows_kept(numbered, key, stored(kept.select("first.row"), "kept"), docs.columns)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op4_simhash"] = op4_simhash
