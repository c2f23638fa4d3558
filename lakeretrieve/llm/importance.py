"""Importance resampling toward a target: documents whose n-grams the target prefers.

A text is lower-cased and its separators blanked by one table of 256 bytes,
which is safe in UTF-8 as all bytes of longer characters map to themselves;
``bytes.split`` gives the words. The checksum of an n-gram is the checksum of the next
word with the shorter n-gram's as its seed, so no n-gram is ever built. Each
task counts buckets in one Counter, and Spark sums the counters. A document's
weight is the sum over its n-grams of the log ratio of both distributions;
Gumbel noise from a hash of its id makes the highest scores a sample without
replacement.

Texts are read twice, for counts and for weights, and never stored or shuffled.
Ranks come from a range partition of narrow rows with counts per partition.

Defined cases: a null text has no words, weight 0, and is not drawn. A null id
hashes as an empty string and comes last among equal scores; rows with equal
ids are separate rows, of equal scores the one with fewer n-grams first. An empty
target makes every bucket equally unlikely in it. Other columns are ignored
by :func:`resampled` and kept by :func:`drawn`. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import rows_kept, stored, unused, with_row_key
from lakeretrieve.llm.registry import QUERIES, table
from lakeretrieve.plans.topk import with_positions

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42

# Lower-case letters, digits and bytes of longer characters stay, A-Z are lowered, the rest is blank.
FOLDED = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(128)) + bytes(range(128, 256))


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLDED).split()


def ngram_buckets(found: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1 to ``longest`` words, repeats included."""
    sums = list(map(crc32, found))
    every, spaced = list(sums), [b" " + w for w in found]
    for n in range(1, longest):
        sums = list(map(crc32, spaced[n:], sums))
        every += sums
    return np.array(every, np.int64) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts; ``buckets`` numbers reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[int] = Counter()
        for rows in batches:
            for value in rows["text"]:
                seen.update(ngram_buckets(split_words(value), longest, buckets).tolist())
        yield pd.DataFrame({"bucket": list(seen.keys()), "n": list(seen.values())}, dtype="int64")

    each = texts.select(F.col(text).cast("binary").alias("text")).mapInPandas(run, "bucket long, n long")
    found = np.zeros(buckets, np.int64)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in ``want`` to that in ``have``."""
    size = len(have)
    all_have, all_want = float(have.sum() + size), float(want.sum() + size)
    return np.array(
        [math.floor(1000 * math.log(float(t + 1) * all_have / (float(s + 1) * all_want))) for s, t in zip(have.tolist(), want.tolist())],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``doc_id, __row, n_words, n_features, weight, score`` of every row of ``doc_id, __row, text``."""
    size = len(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            counts = []
            for value in rows["text"]:
                found = split_words(value)
                at = ngram_buckets(found, longest, size)
                counts.append((len(found), len(at), int(gain[at].sum())))
            made = pd.DataFrame(counts, columns=["n_words", "n_features", "weight"], dtype="int64")
            moved = [noise(None if i is None else int(i), seed) for i in rows["id"]]
            yield made.assign(__row=rows["__row"].to_numpy(), id=rows["id"].to_numpy(), score=made["weight"] + np.array(moved, np.int64))

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Ids as text, so that a null among them leaves the others whole numbers.
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), "__row", F.col("text").cast("binary").alias("text"))
    schema = "id string, __row long, n_words long, n_features long, weight long, score long"
    return texts.mapInPandas(run, schema).withColumn("doc_id", F.col("id").cast(kind)).drop("id")


def ranked(rows: DataFrame, min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT) -> DataFrame:
    """``rows`` of :func:`scored` with ``rank``, null for those not drawn."""
    fit = F.col("n_words") >= min_words
    wanted = percent * rows.where(fit).count() // 100
    order = ["__last", "__unnamed", "doc_id", "n_features", "__row"]
    keyed = rows.where(fit).withColumn("__last", -F.col("score")).withColumn("__unnamed", F.col("doc_id").isNull())
    placed = with_positions(keyed, [], order, "__at").drop("__last", "__unnamed")
    rank = F.when(F.col("__at") <= wanted, F.col("__at")).alias("rank")
    others = rows.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return placed.select(*rows.columns, rank).unionByName(others)


def _numbered(docs: DataFrame) -> DataFrame:
    """Ids and texts with a row number that only orders rows alike in everything else."""
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS, percent: int = DRAWN_PERCENT) -> DataFrame:
    """``doc_id, __row, n_words, n_features, weight, score, rank`` of every row of ``doc_id, text, __row``."""
    gain = gains(bucket_counts(docs, "text", buckets=buckets), bucket_counts(target, text, buckets=buckets))
    return ranked(stored(scored(docs, gain), "scores"), percent=percent)


def drawn(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT) -> DataFrame:
    """The drawn documents with their own columns."""
    key = unused("__row", docs)
    numbered = with_row_key(docs, key)
    taken = resampled(numbered.select("doc_id", "text", F.col(key).alias("__row")), target, percent=percent).where("rank is not null")
    return rows_kept(numbered, key, stored(taken.select("__row"), "taken"), docs.columns)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _numbered(table(spark, sf_dir, "documents"))
    return resampled(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES["op13_importance_resampling"] = op13_importance_resampling
