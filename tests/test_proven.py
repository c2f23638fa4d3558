"""Proven index search against the exact scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeretrieve.functions.metadata import metadata_filter, promote_keys, promoted_filter
from lakeretrieve.operators import vector as op
from lakeretrieve.plans import cells, neighbours, proven


def rows_of(df):
    return sorted((r.qid, r["rank"], r.id, round(r.distance, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    """Clusters of unequal width, a hot spot of equal vectors, a zero vector, and one label that is rare."""
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, 6)) * 5
    rows = [(i, (middles[i % 12] + rng.normal(size=6) * (0.1 + i % 5 / 4)).tolist(), i % 7, i == 77) for i in range(900)]
    rows += [(2000 + i, middles[3].tolist(), 1, False) for i in range(200)]
    rows += [(3000, [0.0] * 6, 1, False), (3001, None, 1, False)]
    meta = F.to_json(F.struct("label", "rare", F.concat(F.lit("k"), F.col("label")).alias("name")))
    plain = spark.createDataFrame(rows, "id bigint, embedding array<double>, label int, rare boolean")
    return plain.select("id", "embedding", meta.alias("metadata"))


@pytest.fixture(scope="module")
def queries(corpus):
    near = corpus.filter("id % 9 = 0 and embedding is not null").select(F.col("id").alias("qid"), F.col("embedding").alias("qvector"))
    far = near.select((-F.col("qid") - 1).alias("qid"), F.transform("qvector", lambda x: 1.5 - x).alias("qvector"))
    return near.unionByName(far)


def built(spark, corpus, path, metric, n=24):
    kinds = {"label": "int", "rare": "boolean", "name": "string"}
    rows = corpus.select("id", "embedding", *promote_keys(F.col("metadata"), kinds))
    model = cells.train_centres(rows, n, metric)
    cells.write_index(cells.assign_cells(rows, model), path)
    index = spark.read.parquet(path)
    return index, proven.with_radii(index, cells.centre_table(spark, model), metric)


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1"])
def test_equals_the_scan(spark, corpus, queries, tmp_path, metric):
    index, centres = built(spark, corpus, str(tmp_path / "i"), metric)
    directed = queries if metric != "cosine" else queries.filter("qid <> 3000")
    exact = op.knn_batch(corpus, directed, 8, metric)
    assert rows_of(proven.nearest_proven(index, centres, queries, 8, metric)) == rows_of(exact)
    cut = exact.agg(F.percentile_approx("distance", 0.5)).first()[0]
    near = op.knn_batch(corpus, directed, 8, metric, below=cut)
    assert rows_of(proven.nearest_proven(index, centres, queries, 8, metric, below=cut)) == rows_of(near)
    for conditions in ({"label": 3}, {"rare": True}, {"name": ["k1", "k2"], "label": 2}, {"label": "4"}, {"name": "none"}):
        wanted = op.knn_batch(corpus, directed, 8, metric, conditions=conditions)
        found = proven.nearest_proven(index, centres, queries, 8, metric, conditions=conditions, first_cells=1, growth=2)
        assert rows_of(found) == rows_of(wanted)


def test_stops_early_and_prunes(spark, corpus, queries, tmp_path, monkeypatch):
    index, centres = built(spark, corpus, str(tmp_path / "i"), "l2")
    read, plain = [], proven.nearest

    def counted(rows, asked, *args, probes, **options):
        read.append(probes.count())
        return plain(rows, asked, *args, probes=probes, **options)

    monkeypatch.setattr(proven, "nearest", counted)
    own = queries.filter("qid >= 0")
    proven.nearest_proven(index, centres, own, 3, "l2", first_cells=1, growth=2).count()
    assert sum(read) < 0.5 * own.count() * centres.filter("rows > 0").count()
    plan = index.filter(promoted_filter(index, {"name": "k1"}) & F.col("cell").isin(1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(meta_name,k1)" in plan and "PartitionFilters: [" in plan and "cell#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_radii_hold_every_row(spark, corpus, tmp_path):
    index, centres = built(spark, corpus, str(tmp_path / "i"), "cosine")
    held = {r.id: (np.array(r.vector), r.radius) for r in centres.collect()}
    assert sum(r.rows for r in centres.collect()) == index.count()
    for r in index.select("cell", "embedding").collect():
        x = np.array(r.embedding)
        middle, radius = held[r.cell]
        assert np.linalg.norm(x / np.linalg.norm(x) - middle) <= radius + 1e-9


def test_promoted_tests_equal_tests_on_text(spark, corpus):
    kept = corpus.select("id", "metadata", *promote_keys(F.col("metadata"), {"label": "int", "rare": "boolean", "name": "string"}))
    for conditions in ({"label": 2}, {"label": 2.5}, {"label": "2"}, {"label": "02"}, {"label": ["1", 5]}, {"rare": True}, {"rare": "true"}, {"name": "k3"}, {"name": 3}, {"name": []}):
        ours = {r.id for r in kept.filter(promoted_filter(kept, conditions)).collect()}
        assert ours == {r.id for r in kept.filter(metadata_filter(F.col("metadata"), conditions)).collect()}, conditions


def test_edges(spark, corpus, tmp_path):
    index, centres = built(spark, corpus, str(tmp_path / "i"), "cosine")
    odd = spark.createDataFrame([(1, [0.0] * 6), (2, None)], "qid bigint, qvector array<double>")
    assert proven.nearest_proven(index, centres, odd, 3).count() == 0
    assert proven.nearest_proven(index, centres, odd.limit(0), 3).count() == 0
    assert proven.nearest_proven(index.limit(0), centres.limit(0), odd, 3).count() == 0
    with pytest.raises(ValueError):
        proven.nearest_proven(index, centres, odd, 0)


def test_later_rounds_emit_only_what_can_still_matter(spark, corpus, queries, tmp_path, monkeypatch):
    index, centres = built(spark, corpus, str(tmp_path / "i"), "l2")
    emitted, plain = [], neighbours.top_per_group

    def counted(found, *args, **options):
        emitted.append(found.count())
        return plain(found, *args, **options)

    monkeypatch.setattr(neighbours, "top_per_group", counted)
    found = rows_of(proven.nearest_proven(index, centres, queries, 8, "l2", first_cells=4, growth=20))
    assert len(emitted) > 1 and sum(emitted[1:]) < emitted[0]
    monkeypatch.undo()
    assert found == rows_of(op.knn_batch(corpus, queries, 8, "l2"))
