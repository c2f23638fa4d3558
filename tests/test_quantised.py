"""The quantised index: models, codes, recall, and rows of equal ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeretrieve.operators import vector as op
from lakeretrieve.plans import cells, quantised


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(15, 16)) * 3
    rows = [(i, (middles[i % 15] + rng.normal(size=16)).tolist()) for i in range(1500)]
    rows += [(1, middles[2].tolist())] * 40 + [(9000, [0.0] * 16), (9001, None)]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_recall_and_blocks(spark, corpus, tmp_path, monkeypatch, metric):
    model = quantised.train(corpus, 20, metric, subspaces=4)
    quantised.write(corpus, model, str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    assert index.count() == 1541 - (metric == "cosine") and index.select("row").distinct().count() == index.count()
    queries = corpus.filter("id % 10 = 3").select(F.col("id").alias("qid"), F.col("embedding").alias("qvector"))
    found = quantised.search(index, model, queries, 10, nprobe=10)
    exact = op.knn_batch(corpus, queries, 10, metric)
    assert cells.recall(found, exact).first()[0] >= 0.9
    most = found.groupBy("qid").count().agg(F.max("count")).first()[0]
    assert most == 10
    key = lambda df: sorted((r.qid, r["rank"], r.id, round(r.distance, 9)) for r in df.collect())
    monkeypatch.setattr(quantised, "BROADCAST_BYTES", 4000)
    assert key(quantised.search(index, model, queries, 10, nprobe=10)) == key(found)
    # All cells and every row ranked exactly is the exact search.
    everything = quantised.search(index, model, queries, 10, nprobe=len(model.centres), reranked=200)
    assert [(q, r, d) for q, r, _, d in key(everything)] == [(q, r, d) for q, r, _, d in key(exact)]


def test_coded_vectors_are_nearer_than_centres():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 8))
    centres = quantised._lloyd(points, 6, 1)
    books = np.stack([quantised._lloyd(rng.normal(size=(300, 2)), 16, j, zero=True) for j in range(4)])
    model = quantised.Model("l2", centres[:1], centres, np.array([0, len(centres)]), books)
    numbers = model.cells_of(points)
    codes = model.codes(points - centres[numbers])
    coded = np.linalg.norm(points - model.decoded(numbers, codes), axis=1)
    assert (coded <= np.linalg.norm(points - centres[numbers], axis=1) + 1e-9).all()
    assert (books[:, 0] == 0).all()


def test_edges(spark, corpus, tmp_path):
    none = corpus.limit(0)
    model = quantised.train(none, subspaces=4)
    quantised.write(none, model, str(tmp_path / "i"))
    with pytest.raises(ValueError, match="cosine or l2"):
        quantised.train(corpus, metric="l1")
    with pytest.raises(ValueError, match="divide"):
        quantised.train(corpus, subspaces=5)
    with pytest.raises(ValueError, match="at least 1"):
        quantised.search(corpus, model, corpus, 0)
    one = corpus.filter("id = 5")
    small = quantised.train(one, subspaces=4)
    quantised.write(one, small, str(tmp_path / "one"))
    asked = corpus.filter("id in (5, 9000)").select(F.col("id").alias("qid"), F.col("embedding").alias("qvector"))
    found = quantised.search(spark.read.parquet(str(tmp_path / "one")), small, asked, 3).collect()
    assert [(r.qid, r.id) for r in found] == [(5, 5)]
