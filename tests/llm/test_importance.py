"""Importance resampling against a plain count of every n-gram."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lakeretrieve.llm import importance
from lakeretrieve.llm.registry import QUERIES
from tests.llm.test_operators import LONG, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF_DIR = "/root/testdata/sf0.001"


def _features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(lowered)
    grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(g.encode()) % 10000 for g in grams]


def _expected(rows, target):
    have, want = Counter(), Counter()
    features = [_features(t) for _, t in rows]
    for _, f in features:
        have.update(f)
    for t in target:
        want.update(_features(t)[1])
    size, all_want = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (size + 10000) / ((have[b] + 1) * (all_want + 10000))))
    made = []
    for (doc_id, _), (n, f) in zip(rows, features):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        made.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in made if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(fit[: 5 * len(fit) // 100], 1):
        r[4] = rank
    return made


def _sorted(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def test_query_equals_plain_counts(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, SF_DIR)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert _sorted(map(tuple, got.collect())) == _sorted(tuple(r[:5]) for r in _expected(docs, target))


ROWS = [(1, prose(2, 120)), (1, prose(2, 120)), (None, prose(4, 70)), (None, None), (5, ""), (6, LONG), (7, "Tiny."), (8, "ÀB\x00c9 İx_日本 Ünï-côde\x7fz " * 8)]
ROWS += [(100 + i, prose(i % 7, 40)) for i in range(60)]


def test_odd_rows_ties_and_clashing_columns(spark):
    names = ["id", "__at", "n_words", "weight", "score", "rank", "__last", "n", "__kept", "__row", "bucket"]
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit("x").alias(n) for n in names])
    target = spark.createDataFrame([(1, prose(3, 50)), (2, None)], "item_id long, text string").withColumn("bucket", F.lit("x"))
    expected = _expected(ROWS, [prose(3, 50), None])
    got = importance.resampled(importance._numbered(docs), target).select("doc_id", "n_features", "weight", "score", "rank")
    assert _sorted(map(tuple, got.collect())) == _sorted(tuple(r[:5]) for r in expected)
    kept = importance.drawn(docs, target)
    assert kept.columns == docs.columns
    assert _sorted([r["doc_id"]] for r in kept.collect()) == _sorted([r[0]] for r in expected if r[4])


def test_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(importance._numbered(docs.limit(0)), target).count() == 0
    got = importance.resampled(importance._numbered(docs), target).select("doc_id", "n_features", "weight", "score", "rank")
    assert _sorted(map(tuple, got.collect())) == _sorted(tuple(r[:5]) for r in _expected(ROWS, []))
