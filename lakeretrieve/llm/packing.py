"""Best-fit packing of documents into sequences, by bin completion.

Only documents longer than a sequence are cut. The packing depends on the
pieces' lengths alone, so what is solved is the histogram of lengths, at most
``capacity`` numbers whatever the corpus holds. Around the largest piece left, the
undominated fillings of the rest of its sequence are enumerated, largest pieces first; a
filling without waste ends the search. The filling is used as often as its
pieces last, so the plan has fewer patterns than there are lengths. Best-fit
decreasing gives the incumbent; while the plan is above the lower bound,
branch and bound goes on within the waste that a better packing may have. A
branch is a filling and how many times it is used, so the search depends on
the lengths and not on the number of sequences; it ends after ``SEARCH_NODES``.

The pieces find their places by rank: the plan says which ranks of a length go to
which sequence and offset. Ranks come from counts per task and length.

Defined cases: a null or empty text is one piece with only the end id. Rows with
equal or null ids are packed each by itself. An empty table gives no rows.
Columns named like an output column are replaced.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from public_tokenizers import path as vocabulary_path
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeretrieve.llm.common import stored, whole
from lakeretrieve.llm.registry import QUERIES, table
from lakeretrieve.llm.tokens import encoder

CAPACITY = 2048
# Partial fillings looked at for one sequence, and in all of the search over whole packings.
FILLING_NODES = 1500
SEARCH_NODES = 300_000

Pattern = tuple[tuple[int, ...], int]  # lengths, largest first, and how many sequences


def fillings(
    counts: Counter, room: int, nodes: int = FILLING_NODES, every: bool = False, budget: list[int] | None = None
) -> Iterator[tuple[int, ...]]:
    """Undominated sets of pieces that fit in ``room``, largest pieces first.

    A set is dominated if one of its pieces can be replaced by a larger free
    one. The first set is the best-fit one; a set without waste is the last
    unless ``every`` one is wanted. The partial sets looked at are taken off ``budget``.
    """
    lengths = sorted(x for x in counts if counts[x] > 0 and x <= room)
    chosen: list[int] = []
    held: Counter = Counter()

    def addable(room: int) -> bool:
        return any(counts[x] > held[x] for x in lengths[: bisect_right(lengths, room)])

    def replaceable(x: int, room: int) -> bool:
        larger = lengths[bisect_right(lengths, x) : bisect_right(lengths, x + room)]
        return any(counts[y] > held[y] for y in larger)

    # Of each chosen piece, and before any: the next length to try, the room left, and whether a piece was added.
    frames = [[bisect_right(lengths, room) - 1, room, False]]
    while frames:
        at, space, fits = frames[-1]
        while at >= 0 and counts[lengths[at]] <= held[lengths[at]]:
            at -= 1
        if at >= 0 and not (fits and nodes <= 0):
            length = lengths[at]
            frames[-1] = [at - 1, space, True]
            frames.append([bisect_right(lengths, min(space - length, length)) - 1, space - length, False])
            chosen.append(length)
            held[length] += 1
            nodes -= 1
            if budget is not None:
                budget[0] -= 1
            continue
        if not fits and not addable(space) and not any(replaceable(x, space) for x in set(chosen)):
            yield tuple(chosen)
            if space == 0 and not every:
                return
        frames.pop()
        if chosen:
            held[chosen.pop()] -= 1


def _lower_bound(counts: Counter, capacity: int) -> int:
    total = sum(x * n for x, n in counts.items())
    return max(-(-total // capacity), sum(n for x, n in counts.items() if 2 * x > capacity))


def complete(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """A packing made sequence by sequence around the largest piece left."""
    counts = Counter({x: n for x, n in histogram.items() if n > 0})
    patterns: list[Pattern] = []
    while counts:
        largest = max(counts)
        counts[largest] -= 1
        best = max(fillings(counts, capacity - largest), key=sum, default=())
        counts[largest] += 1
        pattern = (largest, *best)
        need = Counter(pattern)
        times = min(counts[x] // n for x, n in need.items())
        patterns.append((pattern, times))
        for x, n in need.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
    return patterns


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Largest first, each into the fullest sequence it fits in; equal sequences are counted together."""
    bins: dict[int, Counter] = {}
    for x in sorted(histogram, reverse=True):
        left = histogram[x]
        while left:
            room = next((r for r in sorted(bins) if r >= x), None)
            if room is None:
                per = min(left, capacity // x)
                times = left // per
                bins.setdefault(capacity - per * x, Counter())[(x,) * per] += times
                left -= per * times
                continue
            pattern, times = next(iter(bins[room].items()))
            per = min(left, room // x)
            used = min(times, left // per)
            bins[room][pattern] -= used
            if not bins[room][pattern]:
                del bins[room][pattern]
                if not bins[room]:
                    del bins[room]
            bins.setdefault(room - per * x, Counter())[pattern + (x,) * per] += used
            left -= per * used
    return [(p, n) for held in bins.values() for p, n in held.items()]


def _times(most: int) -> Iterator[int]:
    """All numbers from 1 to ``most``: the halves of ``most`` first."""
    halves = [most >> i for i in range(most.bit_length())]
    yield from halves
    yield from (k for k in range(most - 1, 0, -1) if k not in halves)


def _search(histogram: dict[int, int], capacity: int, limit: int, nodes: list[int], fewer: bool) -> list[Pattern] | None:
    """A packing of at most ``limit`` sequences, by branch and bound, or None if none was found within ``nodes``.

    A filling is used as often as its pieces last and, if ``fewer``, also fewer times.
    """

    def branches(counts: Counter, spare: int, used: frozenset) -> Iterator[tuple[Counter, int, frozenset, Pattern]]:
        """What is left of the pieces and of the waste after each filling around the largest piece, used a number of times."""
        largest = max(counts)
        room, rest = capacity - largest, counts - Counter([largest])

        def options() -> Iterator[tuple[int, ...]]:
            first = max(fillings(rest, room, budget=nodes), key=sum, default=())
            yield first
            others = sorted(fillings(rest, room, every=True, budget=nodes), key=lambda f: (-sum(f), len(f)))
            yield from (f for f in others if f != first)

        for filling in options():
            waste = room - sum(filling)
            if waste > spare:
                return
            pattern = (largest, *filling)
            if pattern in used:
                continue
            need = Counter(pattern)
            most = min(counts[x] // n for x, n in need.items())
            most = min(most, spare // waste) if waste else most
            for times in _times(most) if fewer else (most,):
                nodes[0] -= 1
                after = Counter({x: left for x, n in counts.items() if (left := n - times * need[x])})
                yield after, spare - waste * times, used | {pattern} if largest in after else frozenset(), (pattern, times)

    spare = limit * capacity - sum(x * n for x, n in histogram.items())
    if spare < 0:
        return None
    taken: list[Pattern] = []
    open_ = [branches(Counter(histogram), spare, frozenset())]
    while open_ and nodes[0] > 0:
        branch = next(open_[-1], None)
        if branch is None:
            open_.pop()
            if taken:
                taken.pop()
            continue
        after, spare, used, pattern = branch
        taken.append(pattern)
        if not after:
            return taken
        open_.append(branches(after, spare, used))
    return None


def pack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of the histogram, in as few sequences as were found."""
    least = _lower_bound(Counter(histogram), capacity)
    bins = lambda patterns: sum(n for _, n in patterns)
    best = min(complete(histogram, capacity), best_fit_decreasing(histogram, capacity), key=bins)
    for fewer in (False, True):
        nodes = [SEARCH_NODES // 2]
        while least < bins(best):
            better = _search(histogram, capacity, bins(best) - 1, nodes, fewer)
            if better is None:
                break
            best = better
    return best


PIECES = "part int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces of all documents; ``nth`` counts pieces of a length within a part."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_all = encoder(vocabulary).encode_all
        part, seen = TaskContext.get().partitionId(), Counter()
        for rows in batches:
            out = []
            for doc_id, ids in zip(rows["doc_id"].astype(object), encode_all(rows["text"])):
                ids += end
                cuts = [0, *range(len(ids) // 4 % capacity or capacity, len(ids) // 4 + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    out.append((part, seen[b - a], None if pd.isna(doc_id) else int(doc_id), piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                    seen[b - a] += 1
            made = pd.DataFrame(out, columns=["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.astype({"doc_id": "Int64"})

    return stored(docs.select("doc_id", whole("text").alias("text")).mapInPandas(run, PIECES), "pieces")


def _places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after, pieces a sequence, first sequence, first offset)."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length, per in sorted(Counter(pattern).items(), reverse=True):
            rows.append((length, used[length], used[length] + per * times, per, sequence, offset))
            used[length] += per * times
            offset += per * length
        sequence += times
    return rows


def packed(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and offset."""
    spark = docs.sparkSession
    cut = pieces(docs, vocabulary, end_id, capacity)
    counts = stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        _places(pack(histogram, capacity)), "of long, low long, high long, per long, first long, begin long"
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("length").alias("l"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))).withColumn("rank", F.col("before") + F.col("nth"))
    # No more patterns than lengths and nodes of the search, each with few lengths: a table of bounded size.
    within = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(plan), within)
    nth = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("begin") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), 0)


QUERIES["op7_best_fit_packing"] = op7_best_fit_packing
