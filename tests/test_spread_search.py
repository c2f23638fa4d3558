"""Exact searches dealt to tasks by the distances they measure."""

import numpy as np
import pytest

from lakeretrieve.plans import neighbours


def _tables(spark, path):
    r = np.random.default_rng(5)
    vectors = r.integers(-3, 4, (700, 4)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(i, vectors[0].tolist()) for i in range(700, 730)] + [(None, None), (731, [1.0])]
    spark.createDataFrame(rows, "id long, vector array<double>").write.parquet(path)
    queries = spark.createDataFrame([(i, vectors[i].tolist()) for i in range(0, 700, 20)], "qid long, qvector array<double>")
    return spark.read.parquet(path), queries


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1"])
def test_tasks_grow_with_the_work(spark, tmp_path, monkeypatch, metric):
    corpus, queries = _tables(spark, str(tmp_path / "vectors"))
    expected = sorted(map(tuple, neighbours.nearest(corpus, queries, 5, metric).collect()))
    dealt = []
    plain = neighbours._spread_by_work
    monkeypatch.setattr(neighbours, "TASK_DISTANCES", 1000)
    monkeypatch.setattr(neighbours, "_spread_by_work", lambda *a: dealt.append(plain(*a)) or dealt[-1])
    found = neighbours.nearest(corpus, queries, 5, metric)
    assert sorted(map(tuple, found.collect())) == expected
    # 730 rows of full length and 35 queries: 25,550 distances.
    assert dealt[0].rdd.getNumPartitions() == 26


def test_only_queries_that_rows_enter_are_sorted_again(monkeypatch):
    best = neighbours._Best(np.full(50, np.nan), 2, None)
    best.offer(np.arange(200.0).reshape(50, 4) % 4 + 1, np.arange(4), np.arange(50))
    sorted_rows = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_rows.append(len(keys[-1])) or lexsort(keys))
    best.offer(np.array([[0.5, 9.0], [9.0, 9.0]]), np.array([7, 8]), np.array([3, 4]))
    assert sorted_rows == [3]
    kept = {(q, i) for q, i in zip(best.query.tolist(), best.ids.tolist())}
    assert kept == {(q, i) for q in range(50) for i in ((7, 0) if q == 3 else (0, 1))}
