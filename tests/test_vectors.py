import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.sqlfuncs import register
from lakeretrieve.operators import vector as op
from lakeretrieve.plans import cells
from lakeretrieve.plans.neighbours import nearest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def vec(*xs):
    return F.array(*[F.lit(x) for x in xs])


def test_coerce(spark):
    df = spark.createDataFrame([([1.0, None, 2.5],)], "v array<double>")
    assert df.select(V.coerce_vector(df, "v")).first()[0] == [1.0, 0.0, 2.5]
    df = spark.createDataFrame([([1, 2],)], "v array<int>")
    assert df.select(V.coerce_vector(df, "v")).first()[0] == [1.0, 2.0]
    df = spark.createDataFrame([(["1.5", "x"],)], "v array<string>")
    assert df.select(V.coerce_vector(df, "v")).first()[0] == [0.0, 0.0]
    df = spark.createDataFrame([([True, None],)], "v array<boolean>")
    assert df.select(V.coerce_vector(df, "v")).first()[0] == [1.0, 0.0]


def test_cast_checks_length(spark):
    assert one(spark, V.cast_vector(vec(1.9, -2.0), "int", 2)) == [1, -2]
    with pytest.raises(PySparkException):
        spark.range(1).select(V.cast_vector(vec(1.0), "float", 2)).collect()


def test_distances(spark):
    assert one(spark, V.distance("cosine", vec(1.0, 0.0), vec(0.0, 1.0))) == pytest.approx(1.0)
    assert one(spark, V.distance("l2", vec(0.0, 0.0), vec(3.0, 4.0))) == pytest.approx(5.0)
    assert one(spark, V.distance("Manhattan", vec(0.0, 0.0), vec(3.0, -4.0))) == pytest.approx(7.0)
    assert one(spark, V.distance("nonsense", vec(1.0, 1.0), vec(2.0, 2.0))) == pytest.approx(0.0, abs=1e-12)
    # parallel constant vectors, zero norm, unequal lengths
    assert one(spark, V.distance("cosine", vec(*[0.1] * 64), vec(*[0.2] * 64))) == pytest.approx(0.0, abs=1e-12)
    assert one(spark, V.distance("cosine", vec(0.0, 0.0), vec(1.0, 0.0))) is None
    for metric in ("cosine", "l2", "l1"):
        assert one(spark, V.distance(metric, vec(1.0), vec(1.0, 2.0))) is None


def test_sql_functions_agree(spark):
    register(spark)
    a, b = vec(0.3, -1.0, 2.0), vec(1.5, 0.25, -0.5)
    for metric in ("cosine", "l2", "l1"):
        want = one(spark, V.distance(metric, a, b))
        got = one(spark, F.expr(f"{metric}_distance(array(0.3D, -1D, 2D), array(1.5D, 0.25D, -0.5D))"))
        assert got == pytest.approx(want)


def test_scores(spark):
    assert one(spark, V.score("cosine", F.lit(0.1))) == pytest.approx(0.95)
    assert one(spark, V.score("COSINE", F.lit(2.5))) == 0.0
    assert one(spark, V.score("l2", F.lit(1.0))) == 0.5
    assert one(spark, V.score("unknown", F.lit(1.0))) == 0.5
    assert one(spark, V.hybrid_score(F.lit(1.5))) == -0.5


def test_hash_embedding(spark):
    import hashlib

    for text in ("hello", "", "é汉"):
        digest = hashlib.md5(text.encode()).digest()
        want = [digest[i % 16] / 255.0 for i in range(40)]
        assert one(spark, V.hash_embedding(F.lit(text), 40)) == pytest.approx(want)


def brute(corpus, queries, metric, k, below=None):
    out = {}
    for qid, q in queries:
        rows = []
        for i, v in corpus:
            if v is None or len(v) != len(q) or any(x is None for x in v):
                continue
            a, b = np.array(q, float), np.array(v, float)
            if metric == "cosine":
                n = np.linalg.norm(a) * np.linalg.norm(b)
                if n == 0:
                    continue
                d = round(max(0.0, 1 - float(a @ b) / n), 12)
            else:
                d = float(np.sqrt(((a - b) ** 2).sum()) if metric == "l2" else np.abs(a - b).sum())
            if below is None or d < below:
                rows.append((d, i))
        out[qid] = [i for _, i in sorted(rows)[:k]]
    return out


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one vector; some rows are unusable."""
    rng = np.random.default_rng(7)
    corpus = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(200)]
    corpus += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.5]) for i in range(130)]
    corpus += [(5000, None), (5001, [1.0, 2.0]), (5002, [0.0] * 6), (5003, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    queries = [(i, corpus[i][1]) for i in range(20)] + [(50, [1.0, 2.0, 0.0, 0.0, 1.0, 0.4]), (51, [0.0] * 6)]
    return (
        corpus,
        queries,
        spark.createDataFrame(corpus, "id bigint, vector array<double>").repartition(5).cache(),
        spark.createDataFrame(queries, "qid bigint, qvector array<double>").cache(),
    )


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1"])
@pytest.mark.parametrize("layout", ["broadcast", "tiles"])
def test_nearest_equals_brute_force(skewed, metric, layout):
    corpus, queries, c, q = skewed
    found = nearest(c, q, 7, metric, layout=layout, tile_rows=60).collect()
    got = {qid: [] for qid, _ in queries}
    for row in sorted(found, key=lambda r: (r.qid, r["rank"])):
        got[row.qid].append(row.id)
    assert got == brute(corpus, queries, metric, 7)


def test_nearest_string_ids_and_threshold(spark, skewed):
    corpus, queries, c, q = skewed
    named = c.withColumn("id", F.concat(F.lit("n"), F.col("id")))
    found = nearest(named, q, 5, "l2", below=1.5).collect()
    want = brute([(f"n{i}", v) for i, v in corpus], queries, "l2", 5, 1.5)
    got = {qid: [] for qid, _ in queries}
    for row in sorted(found, key=lambda r: (r.qid, r["rank"])):
        got[row.qid].append(row.id)
    assert got == want


def test_large_query_table_takes_tiles(skewed):
    corpus, queries, c, q = skewed
    found = nearest(c, q, 3, broadcast_bytes=100, tile_rows=50)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    assert found.count() == sum(len(x) for x in brute(corpus, queries, "cosine", 3).values())


@pytest.mark.parametrize("layout", ["broadcast", "tiles"])
@pytest.mark.parametrize("metric", ["cosine", "l1"])
def test_sample_bound_changes_nothing(skewed, metric, layout):
    corpus, queries, c, q = skewed
    found = nearest(c, q, 4, metric, layout=layout, tile_rows=60, many_candidates=1, sample_rows=90).collect()
    got = {qid: [] for qid, _ in queries}
    for row in sorted(found, key=lambda r: (r.qid, r["rank"])):
        got[row.qid].append(row.id)
    assert got == brute(corpus, queries, metric, 4)


def test_single_query_equals_batch(skewed):
    corpus, queries, c, q = skewed
    table = c.withColumnRenamed("vector", "embedding")
    for metric in ("cosine", "l2", "l1"):
        rows = op.knn(table, queries[0][1], 9, metric).select("id").collect()
        assert [r.id for r in rows] == brute(corpus, queries[:1], metric, 9)[queries[0][0]]


def test_mixed_query_lengths_are_rejected(spark, skewed):
    q = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "qid int, qvector array<double>")
    with pytest.raises(ValueError):
        nearest(skewed[2], q, 1)


def test_filters(spark):
    rows = [
        ("a", '{"category":"tech","n":5,"ok":true}', [1.0, 0.0]),
        ("b", '{"category":"food","n":5,"ok":true}', [1.0, 0.1]),
        ("c", '{"category":"tech","n":6,"ok":false}', [1.0, 0.2]),
        ("d", None, [1.0, 0.3]),
        ("e", "not json", [1.0, 0.4]),
        ("f", '{"a.b":"x","ok":"true"}', [1.0, 0.5]),
    ]
    corpus = spark.createDataFrame(rows, "id string, metadata string, embedding array<double>")

    def ids(conditions):
        return [r.id for r in op.knn(corpus, [1.0, 0.0], 10, conditions=conditions).collect()]

    assert ids({"category": "tech"}) == ["a", "c"]
    assert ids({"category": "tech", "n": 5}) == ["a"]
    assert ids({"n": 5.0}) == ["a", "b"]
    assert ids({"ok": True}) == ["a", "b"]
    assert ids({"category": ["food", "none"]}) == ["b"]
    assert ids({"a.b": "x"}) == ["f"]
    assert ids({"ignored": {"x": 1}}) == ["a", "b", "c", "d", "e", "f"]


def mmr_reference(query, items, k, trade):
    if len(items) <= k:
        return list(range(len(items)))

    def cos(a, b):
        return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))

    picked, left = [0], list(range(1, len(items)))
    while len(picked) < k and left:
        best, best_gain = None, -np.inf
        for i in left:
            gain = trade * cos(query, items[i]) - (1 - trade) * max(0.0, max(cos(items[i], items[j]) for j in picked))
            if gain > best_gain + 1e-12:
                best, best_gain = i, gain
        picked.append(best)
        left.remove(best)
    return picked


def test_mmr(spark):
    rng = np.random.default_rng(3)
    corpus = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    queries = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(8)]
    c = spark.createDataFrame(corpus, "id bigint, embedding array<double>")
    q = spark.createDataFrame(queries, "qid bigint, qvector array<double>")
    for k, trade in ((4, 0.5), (6, 0.1), (0, 0.5)):
        got = {}
        for r in sorted(op.mmr_batch(c, q, k, 12, trade).collect(), key=lambda r: (r.qid, r["rank"])):
            got.setdefault(r.qid, []).append(r.id)
        near = brute(corpus, queries, "cosine", 12)
        for qid, query in queries:
            items = [corpus[i][1] for i in near[qid]]
            want = [near[qid][j] for j in mmr_reference(query, items, max(k, 1), trade)]
            assert got[qid] == want
    few = op.mmr_batch(c, q, 12, 12).groupBy("qid").count().collect()
    assert {r["count"] for r in few} == {12}


def test_ingest_ids(spark):
    texts = spark.createDataFrame([("x", None), ("x", '{"a":1}')], "content string, metadata string")
    rows = op.prepare_texts(texts, lambda c: V.hash_embedding(c, 4)).collect()
    assert len(rows) == 2 and rows[0].id == rows[1].id and {r.metadata for r in rows} == {"{}", '{"a":1}'}
    assert len({r.id for r in op.prepare_texts(texts, ids="uuid").collect()}) == 2


def test_dimension(spark):
    assert op.dimension(spark.createDataFrame([([1.0, 2.0],)], "embedding array<double>")).first()[0] == 2
    assert op.dimension(spark.createDataFrame([], "embedding array<double>")).first()[0] == 1536
    with pytest.raises(PySparkException):
        op.dimension(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "embedding array<double>")).collect()


def test_index_recall_and_hot_cell(spark, tmp_path):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(8, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=8)]) for i in range(600)]
    rows += [(1000 + i, [float(x) for x in centres[0]]) for i in range(300)]
    corpus = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    queries = corpus.select(F.col("id").alias("qid"), F.col("embedding").alias("qvector"))
    model = cells.train_centres(corpus, 16)
    path = str(tmp_path / "cells")
    cells.write_index(cells.assign_cells(corpus, model), path)
    index, centre_rows = spark.read.parquet(path), cells.centre_table(spark, model)
    exact = op.knn_batch(corpus, queries, 10)
    found = cells.search_cells(index, centre_rows, queries, 10, nprobe=4)
    assert cells.recall(found, exact).first()[0] >= 0.9
    everything = cells.search_cells(index, centre_rows, queries, 10, nprobe=16)
    key = lambda df: sorted((r.qid, r["rank"], r.id) for r in df.collect())
    assert key(everything) == key(exact)
    tiled = cells.search_cells(index, centre_rows, queries, 10, nprobe=4, layout="tiles", tile_rows=100)
    assert key(tiled) == key(found)
    assert cells.index_name("t") == cells.index_name("t") != cells.index_name("u")


def test_zero_vectors_stay_out_of_cells(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])], "id int, embedding array<double>")
    model = cells.train_centres(corpus, 2)
    assert {r.id for r in cells.assign_cells(corpus, model).collect()} == {1, 3}
