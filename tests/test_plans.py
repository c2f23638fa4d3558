"""The plans that make the operators hold at scale."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeretrieve.operators import blobs, chat, keyed, vector
from lakeretrieve.plans import postings as P
from lakeretrieve.plans.spread import scan_splits, spread

SF = "/root/testdata/sf0.001"


def plan(df, mode="executedPlan"):
    return getattr(df._jdf.queryExecution(), mode)().toString()


def test_top_k_is_limited_before_the_shuffle(spark):
    log = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), "ts"
    )
    text = plan(chat.last_messages(log, 3))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_prefix_and_columns_reach_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([("a/1", bytearray(b"x"))], "key string, value binary")
    blobs.blob_rows(rows).write.parquet(str(tmp_path / "b"))
    text = plan(blobs.list_files(spark.read.parquet(str(tmp_path / "b")), "a/"))
    assert "StringStartsWith(key,a/)" in text
    assert "value:" not in text.split("ReadSchema:")[1]


def test_small_requests_do_not_shuffle_the_store(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value")).write.parquet(str(tmp_path / "kv"))
    store = spark.read.parquet(str(tmp_path / "kv"))
    requests = spark.createDataFrame([(0, "5")], "ord int, key string")
    text = plan(keyed.requested_rows(requests, store))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_knn_single_is_a_take_ordered(spark):
    corpus = spark.read.parquet(f"{SF}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    text = plan(vector.knn(corpus, [0.1] * 64, 4))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_stored_postings_prune_buckets_and_terms(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma")], "id int, content string")
    path = str(tmp_path / "p")
    P.write_postings(P.build_postings(docs), path, buckets=8, salts=2)
    queries = spark.createDataFrame([(1, "alpha")], "qid int, query string")
    text = plan(P.search_postings(spark.read.parquet(path), queries, None, "any", buckets=8))
    assert "bucket" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "EqualTo(term,alpha)" in text


def test_hot_term_is_spread_over_files(spark, tmp_path):
    docs = spark.range(2000).select("id", F.lit("hot").alias("content"))
    path = str(tmp_path / "p")
    # Small partitions would be merged here; at scale they are not small.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        P.write_postings(P.build_postings(docs), path, buckets=4, salts=8)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 6 and max(sizes) < 1000


def test_spread_only_touches_small_scans(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    assert scan_splits(small) == 1
    assert "RoundRobinPartitioning" in plan(spread(small))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        assert "Exchange" not in plan(spread(small))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_kernel_keeps_enough_copies(metric):
    from lakeretrieve.plans.neighbours import _without_surplus_copies

    block = np.vstack([np.tile([1.0, 2.0], (50, 1)), np.random.default_rng(0).normal(size=(10, 2))])
    ids = np.random.default_rng(1).permutation(60)
    kept_ids, kept = _without_surplus_copies(ids, block, 3)
    copies = sorted(ids[:50])[:3]
    assert sorted(kept_ids[(kept == [1.0, 2.0]).all(axis=1)]) == copies and len(kept) == 13
