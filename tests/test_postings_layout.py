"""Stored postings of tables of unlike sizes."""

from pyspark.sql import functions as F

from lakeretrieve.plans import postings


def _layout(spark, path, monkeypatch, task_bytes):
    texts = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 40))) for i in range(2000)]
    spark.createDataFrame(texts, "id long, content string").write.parquet(f"{path}/texts")
    monkeypatch.setattr(postings, "TASK_BYTES", task_bytes)
    built = postings.build_postings(spark.read.parquet(f"{path}/texts"))
    postings.write_postings(built, f"{path}/index", buckets=2, salts=2)
    stored = spark.read.parquet(f"{path}/index")
    assert sorted(map(tuple, stored.select("term", "id", "pos").collect())) == sorted(map(tuple, built.collect()))
    return len(stored.inputFiles())


def test_salts_grow_with_the_table(spark, tmp_path, monkeypatch):
    assert _layout(spark, str(tmp_path / "small"), monkeypatch, 1 << 30) <= 4
    assert _layout(spark, str(tmp_path / "large"), monkeypatch, 2048) > 8


def test_counts_by_id_take_more_tasks_and_shuffle_no_postings(spark, tmp_path, monkeypatch):
    """An id's texts share a task whose size does not grow with the table."""
    texts = [(i % 1500, " ".join(f"w{(i * j) % 97}" for j in range(1, 40))) for i in range(2000)] + [(None, "a b"), (1, None)]
    spark.createDataFrame(texts, "id long, content string").write.parquet(str(tmp_path / "texts"))
    corpus = spark.read.parquet(str(tmp_path / "texts"))
    monkeypatch.setattr(postings, "TASK_BYTES", 1024)
    built = postings.build_postings(corpus, by_id=True)
    assert built.rdd.getNumPartitions() > 3 * spark.sparkContext.defaultParallelism
    assert sorted(map(str, built.collect())) == sorted(map(str, postings.build_postings(corpus).collect()))
    counts = built.groupBy("id").agg(F.count_distinct("term").alias("terms"))
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    expected = {}
    for i, text in texts:
        if text:
            expected.setdefault(i, set()).update(text.split())
    assert {r["id"]: r["terms"] for r in counts.collect()} == {i: len(x) for i, x in expected.items()}
