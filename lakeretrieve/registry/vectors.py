"""Queries on vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lakeretrieve.functions import vectors as V
from lakeretrieve.functions.metadata import promote_keys
from lakeretrieve.functions.sqlfuncs import register
from lakeretrieve.operators import vector as op
from lakeretrieve.plans import cells, proven, quantised
from lakeretrieve.registry.base import CORPUS_SQL, VECTORS_SQL, Tables, query, r6
from lakeretrieve.session import scratch_path

L1_SQL = "list_sum(list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2])))"


def _sum(array) -> F.Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


@query(
    "v01_coerce_vector",
    """SELECT vec_id AS id, len(embedding) AS n,
         round(list_sum(list_transform(embedding::DOUBLE[], lambda x: CASE WHEN x < 0 THEN 0.0 ELSE x END)), 6) AS total
       FROM embeddings""",
)
def coerce(t: Tables):
    holes = t.read("embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: F.when(x >= 0, x)).alias("v"),
    )
    full = holes.select("id", V.coerce_vector(holes, "v").alias("v"))
    return full.select("id", F.size("v").cast("bigint").alias("n"), r6(_sum(F.col("v"))).alias("total"))


@query(
    "v02_cast_vector",
    """SELECT vec_id AS id,
         list_sum(list_transform(embedding::DOUBLE[], lambda x: floor(x * 100)))::BIGINT AS total
       FROM embeddings""",
)
def cast(t: Tables):
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100))
    small = t.read("embeddings").select(
        F.col("vec_id").alias("id"), V.cast_vector(scaled, "tinyint", 64).alias("v")
    )
    return small.select("id", _sum(F.col("v")).cast("bigint").alias("total"))


_REPRESENTATIVE_SQL = f"""WITH {VECTORS_SQL},
  rep AS (SELECT label, arg_min(v, id) AS r FROM vecs GROUP BY label),
  pairs AS (SELECT id, v, r FROM vecs JOIN rep USING (label))"""


def _pairs(t: Tables):
    """Each vector beside the first vector of its label."""
    first = t.vectors.groupBy("label").agg(F.min_by("embedding", "id").alias("r"))
    return t.vectors.join(first, "label").select("id", F.col("embedding").alias("v"), "r")


@query(
    "v03_cosine_distance",
    _REPRESENTATIVE_SQL + " SELECT id, round(greatest(0, list_cosine_distance(v, r)), 6) AS distance FROM pairs",
)
def cosine(t: Tables):
    register(t.spark)
    _pairs(t).createOrReplaceTempView("vector_pairs")
    return t.spark.sql("SELECT id, round(cosine_distance(v, r), 6) AS distance FROM vector_pairs")


@query("v04_l2_distance", _REPRESENTATIVE_SQL + " SELECT id, round(list_distance(v, r), 6) AS distance FROM pairs")
def l2(t: Tables):
    return _pairs(t).select("id", r6(V.l2_distance(F.col("v"), F.col("r"))).alias("distance"))


@query(
    "v05_l1_distance",
    _REPRESENTATIVE_SQL + f" SELECT id, round({L1_SQL.format(a='v', b='r')}, 6) AS distance FROM pairs",
)
def l1(t: Tables):
    return _pairs(t).select("id", r6(V.l1_distance(F.col("v"), F.col("r"))).alias("distance"))


@query(
    "v06_metric_dispatch",
    _REPRESENTATIVE_SQL
    + f""" SELECT id, round(list_distance(v, r), 6) AS euclidean,
             round({L1_SQL.format(a='v', b='r')}, 6) AS manhattan,
             round(greatest(0, list_cosine_distance(v, r)), 6) AS cosine,
             round(greatest(0, list_cosine_distance(v, r)), 6) AS unknown
           FROM pairs""",
)
def dispatch(t: Tables):
    v, r = F.col("v"), F.col("r")
    names = {"euclidean": "Euclidean", "manhattan": "MANHATTAN", "cosine": "Cosine", "unknown": "hamming"}
    return _pairs(t).select("id", *[r6(V.distance(m, v, r)).alias(c) for c, m in names.items()])


@query(
    "v07_scores",
    _REPRESENTATIVE_SQL
    + """ SELECT id, round(greatest(0, 1 - list_cosine_distance(v, r) / 2), 6) AS cosine,
            round(1 / (1 + list_distance(v, r)), 6) AS l2,
            round(1 / (1 + greatest(0, list_cosine_distance(v, r))), 6) AS unknown
          FROM pairs""",
)
def scores(t: Tables):
    v, r = F.col("v"), F.col("r")
    return _pairs(t).select(
        "id",
        *[r6(V.score(m, V.distance(m, v, r))).alias(m) for m in ("cosine", "l2", "unknown")],
    )


@query(
    "v08_hybrid_scores",
    _REPRESENTATIVE_SQL
    + """ SELECT id, round(1 - greatest(0, list_cosine_distance(v, r)), 6) AS cosine,
            round(1 - list_distance(v, r), 6) AS l2 FROM pairs""",
)
def hybrid_scores(t: Tables):
    v, r = F.col("v"), F.col("r")
    return _pairs(t).select(
        "id", *[r6(V.hybrid_score(V.distance(m, v, r))).alias(m) for m in ("cosine", "l2")]
    )


_FIRST_SQL = "q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings ORDER BY vec_id LIMIT 1)"


@query(
    "v09_knn",
    f"""WITH {CORPUS_SQL}, {_FIRST_SQL},
      d AS (SELECT id, greatest(0, list_cosine_distance(embedding, qv)) AS distance FROM corpus, q)
      SELECT id, round(distance, 6) AS distance, round(1 - distance / 2, 6) AS score
      FROM d ORDER BY round(distance, 12), id LIMIT 4""",
)
def knn(t: Tables):
    return op.knn(t.corpus, t.first_vector(), 4).select("id", r6("distance").alias("distance"), r6("score").alias("score"))


@query(
    "v10_knn_without_scores",
    f"""WITH {CORPUS_SQL}, {_FIRST_SQL}
      SELECT id, md5(content) AS content_md5 FROM corpus, q
      ORDER BY list_distance(embedding, qv), id LIMIT 10""",
)
def knn_plain(t: Tables):
    hits = op.knn(t.corpus, t.first_vector(), 10, "l2", with_score=False)
    return hits.select("id", F.md5("content").alias("content_md5"))


@query(
    "v11_knn_by_vector",
    f"""WITH {CORPUS_SQL}, {_FIRST_SQL}
      SELECT md5(content) AS content_md5, lang, label FROM corpus, q
      ORDER BY {L1_SQL.format(a='embedding', b='qv')}, id LIMIT 10""",
)
def knn_by_vector(t: Tables):
    hits = op.knn(t.corpus, t.first_vector(), 10, "l1", with_score=False)
    return hits.select(
        F.md5("content").alias("content_md5"),
        F.get_json_object("metadata", "$.lang").alias("lang"),
        F.get_json_object("metadata", "$.label").cast("int").alias("label"),
    )


def _batch_sql(distance: str, score: str, k: int, where: str = "TRUE") -> str:
    return f"""WITH {VECTORS_SQL},
      d AS (SELECT a.id AS qid, b.id AS id, {distance} AS distance FROM vecs a, vecs b),
      r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 12), id) AS rank
            FROM d WHERE {where})
      SELECT qid, rank::INTEGER AS rank, id, round(distance, 6) AS distance, round({score}, 6) AS score
      FROM r WHERE rank <= {k}"""


_COSINE = "greatest(0, list_cosine_distance(a.v, b.v))"


def _batch(t: Tables, k: int, metric: str, **options):
    hits = op.knn_batch(t.vectors, t.vector_queries, k, metric, **options)
    return hits.select("qid", "rank", "id", r6("distance").alias("distance"), r6("score").alias("score"))


@query("v12_knn_batch_cosine", _batch_sql(_COSINE, "1 - distance / 2", 10))
def batch_cosine(t: Tables):
    return _batch(t, 10, "cosine")


@query("v12_knn_batch_l2", _batch_sql("list_distance(a.v, b.v)", "1 / (1 + distance)", 10))
def batch_l2(t: Tables):
    return _batch(t, 10, "l2")


@query("v12_knn_batch_l1", _batch_sql(L1_SQL.format(a="a.v", b="b.v"), "1 / (1 + distance)", 10))
def batch_l1(t: Tables):
    return _batch(t, 10, "l1")


@query("v12_knn_batch_tiles", _batch_sql(_COSINE, "1 - distance / 2", 4))
def batch_tiles(t: Tables):
    return _batch(t, 4, "cosine", layout="tiles")


def _filter_sql(where: str) -> str:
    return f"""WITH {CORPUS_SQL}, {_FIRST_SQL},
      d AS (SELECT id, lang, source, label, greatest(0, list_cosine_distance(embedding, qv)) AS distance
            FROM corpus, q WHERE {where})
      SELECT id, lang, source, label, round(distance, 6) AS distance
      FROM d ORDER BY round(distance, 12), id LIMIT 10"""


def _filtered(t: Tables, conditions: dict):
    hits = op.knn(t.corpus, t.first_vector(), 10, conditions=conditions)
    return hits.select(
        "id",
        F.get_json_object("metadata", "$.lang").alias("lang"),
        F.get_json_object("metadata", "$.source").alias("source"),
        F.get_json_object("metadata", "$.label").cast("int").alias("label"),
        r6("distance").alias("distance"),
    )


@query("v13_knn_metadata_filter", _filter_sql("lang = 'en' AND label = 3"))
def metadata_equality(t: Tables):
    return _filtered(t, {"lang": "en", "label": 3})


@query("v14_knn_metadata_in", _filter_sql("lang IN ('fr', 'de') AND source = 'src4'"))
def metadata_in(t: Tables):
    return _filtered(t, {"lang": ["fr", "de"], "source": "src4"})


@query(
    "v15_threshold",
    f"""WITH {VECTORS_SQL}, {_FIRST_SQL},
      d AS (SELECT id, list_distance(v, qv) AS distance FROM vecs, q)
      SELECT id, round(distance, 6) AS distance FROM d WHERE distance < 1.3 ORDER BY d.distance, id LIMIT 20""",
)
def threshold(t: Tables):
    return op.knn(t.vectors, t.first_vector(), 20, "l2", below=1.3).select("id", r6("distance").alias("distance"))


@query("v15_threshold_batch", _batch_sql(_COSINE, "1 - distance / 2", 10, "distance < 0.7"))
def threshold_batch(t: Tables):
    return _batch(t, 10, "cosine", below=0.7)


_MMR_SQL = f"""WITH RECURSIVE {VECTORS_SQL},
  c AS MATERIALIZED (
    SELECT qid, id, qv, v, rank FROM (
      SELECT a.id AS qid, b.id AS id, a.v AS qv, b.v AS v,
             row_number() OVER (PARTITION BY a.id ORDER BY round({_COSINE}, 12), b.id) AS rank
      FROM vecs a, vecs b) WHERE rank <= 20),
  sims AS MATERIALIZED (
    SELECT x.qid, x.rank AS i, y.rank AS j, list_cosine_similarity(x.v, y.v) AS sim
    FROM c x JOIN c y USING (qid)),
  picks AS (
    SELECT qid, 1 AS step, [1::BIGINT] AS chosen FROM c WHERE rank = 1
    UNION ALL
    SELECT qid, step + 1, list_append(chosen, nxt) FROM (
      SELECT p.qid, any_value(p.step) AS step, any_value(p.chosen) AS chosen,
             arg_min(c.rank, (-g.gain, c.rank)) AS nxt
      FROM picks p JOIN c ON c.qid = p.qid AND NOT list_contains(p.chosen, c.rank)
      JOIN LATERAL (
        SELECT round(0.5 * list_cosine_similarity(c.qv, c.v)
                     - 0.5 * greatest(0, max(s.sim)), 12) AS gain
        FROM sims s WHERE s.qid = p.qid AND s.i = c.rank AND list_contains(p.chosen, s.j)) g ON TRUE
      WHERE p.step < 4 GROUP BY p.qid)),
  final AS (SELECT qid, unnest(chosen) AS pick, generate_subscripts(chosen, 1) AS rank
            FROM picks WHERE step = 4)
  SELECT f.qid, f.rank::INTEGER AS rank, c.id,
         round(greatest(0, list_cosine_distance(c.qv, c.v)), 6) AS distance
  FROM final f JOIN c ON c.qid = f.qid AND c.rank = f.pick"""


@query("v16_mmr", _MMR_SQL)
def mmr(t: Tables):
    picks = op.mmr_batch(t.vectors, t.vector_queries, 4, 20, 0.5)
    return picks.select("qid", "rank", "id", r6("distance").alias("distance"))


_HASH_SQL = "list_transform(range(0, 32), lambda i: ('0x' || substr(md5(text), 2 * (i % 16) + 1, 2))::INTEGER / 255.0::DOUBLE)"


@query(
    "v17_ingest_texts",
    f"""SELECT md5(text) AS id, md5(text) AS content_md5, lang, len({_HASH_SQL}) AS dim,
          round(list_sum({_HASH_SQL}), 4) AS total
        FROM documents""",
)
def ingest(t: Tables):
    rows = op.prepare_texts(t.texts.select("content", "metadata"), lambda c: V.hash_embedding(c, 32))
    return rows.select(
        "id",
        F.md5("content").alias("content_md5"),
        F.get_json_object("metadata", "$.lang").alias("lang"),
        F.size("embedding").cast("bigint").alias("dim"),
        F.round(_sum(F.col("embedding")), 4).alias("total"),
    )


@query(
    "v18_delete_by_ids",
    "SELECT vec_id AS id, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def delete(t: Tables):
    toxic = t.read("labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    return op.delete_ids(t.vectors, toxic).select("id", "label")


@query(
    "v19_embed_with_model",
    """SELECT doc_id AS id, 4 AS dim, round(length(text) / 1000.0::DOUBLE, 6) AS kchars,
         len(string_split(text, ' ')) AS words FROM documents""",
)
def embed_with_model(t: Tables):
    @F.pandas_udf("array<double>")
    def model(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: [len(s) / 1000.0, float(s.count(" ") + 1), float(s.count("\n")), 1.0])

    return op.embed(t.texts, "content", model).select(
        "id",
        F.size("embedding").alias("dim"),
        r6(F.col("embedding")[0]).alias("kchars"),
        F.col("embedding")[1].cast("bigint").alias("words"),
    )


@query(
    "v20_hash_embedding",
    f"SELECT doc_id AS id, round(list_sum({_HASH_SQL}), 6) AS total, round(({_HASH_SQL})[20], 6) AS x20 FROM documents",
)
def hash_embedding(t: Tables):
    rows = t.texts.select("id", V.hash_embedding(F.col("content"), 32).alias("v"))
    return rows.select("id", r6(_sum(F.col("v"))).alias("total"), r6(F.col("v")[19]).alias("x20"))


@query("v21_dimension", "SELECT max(len(embedding))::INTEGER AS dimension FROM embeddings")
def dimension(t: Tables):
    return op.dimension(t.vectors)


def _index(t: Tables):
    """Train, assign and store the vector index; returns it with its centres."""
    model = cells.train_centres(t.vectors)
    path = scratch_path(t.spark, "vector-index")
    cells.write_index(cells.assign_cells(t.vectors, model), path)
    return t.spark.read.parquet(path), cells.centre_table(t.spark, model)


@query("v22_build_vector_index")
def build_index(t: Tables):
    index, _ = _index(t)
    return index.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query("v23_search_vector_index")
def search_index(t: Tables):
    index, centres = _index(t)
    found = cells.search_cells(index, centres, t.vector_queries, 10, nprobe=8)
    return found.select("qid", "rank", "id", r6("distance").alias("distance"))


@query("v23_search_all_cells", _batch_sql(_COSINE, "1 - distance / 2", 10))
def search_all_cells(t: Tables):
    """Every cell is probed, so the index gives the exact neighbours."""
    index, centres = _index(t)
    found = cells.search_cells(index, centres, t.vector_queries, 10, nprobe=centres.count())
    scored = found.withColumn("score", V.score("cosine", F.col("distance")))
    return scored.select("qid", "rank", "id", r6("distance").alias("distance"), r6("score").alias("score"))


@query(
    "v25_promote_metadata",
    f"WITH {CORPUS_SQL} SELECT id, lang AS meta_lang, label AS meta_label FROM corpus",
)
def promote(t: Tables):
    path = scratch_path(t.spark, "promoted")
    t.corpus.select("id", *promote_keys(F.col("metadata"), {"lang": "string", "label": "int"})).write.parquet(path)
    return t.spark.read.parquet(path)


def _promoted_index(t: Tables, corpus):
    """An index of rows with promoted metadata, and its centres with radii."""
    rows = corpus.select("id", "embedding", *promote_keys(F.col("metadata"), {"lang": "string", "label": "int"}))
    model = cells.train_centres(rows)
    path = scratch_path(t.spark, "promoted-index")
    cells.write_index(cells.assign_cells(rows, model), path)
    index = t.spark.read.parquet(path)
    return index, proven.with_radii(index, cells.centre_table(t.spark, model))


def _condition_sql(where: str, k: int) -> str:
    return f"""WITH {CORPUS_SQL},
      d AS (SELECT a.vec_id AS qid, b.id, greatest(0, list_cosine_distance(a.embedding::DOUBLE[], b.embedding)) AS distance
            FROM embeddings a, corpus b WHERE {where}),
      r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 12), id) AS rank FROM d)
      SELECT qid, rank::INTEGER AS rank, id, round(distance, 6) AS distance FROM r WHERE rank <= {k}"""


@query("v23_filtered", _condition_sql("b.lang IN ('fr', 'de') AND b.label = 3", 10))
def search_filtered(t: Tables):
    """The ten nearest rows that meet a condition, proven from the cells' radii."""
    index, centres = _promoted_index(t, t.corpus)
    found = proven.nearest_proven(index, centres, t.vector_queries, 10, conditions={"lang": ["fr", "de"], "label": 3})
    return found.select("qid", "rank", "id", r6("distance").alias("distance"))


@query("v23_proven", _batch_sql(_COSINE, "1 - distance / 2", 10))
def search_proven(t: Tables):
    """No number of probes: each query reads cells until its neighbours are proven."""
    index, centres = _index(t)
    found = proven.nearest_proven(index, proven.with_radii(index, centres), t.vector_queries, 10)
    scored = found.withColumn("score", V.score("cosine", F.col("distance")))
    return scored.select("qid", "rank", "id", r6("distance").alias("distance"), r6("score").alias("score"))


@query("v23_threshold", _batch_sql(_COSINE, "1 - distance / 2", 10, "distance < 0.7"))
def search_threshold(t: Tables):
    """A threshold limits the cells that are read."""
    index, centres = _index(t)
    found = proven.nearest_proven(index, proven.with_radii(index, centres), t.vector_queries, 10, below=0.7)
    scored = found.withColumn("score", V.score("cosine", F.col("distance")))
    return scored.select("qid", "rank", "id", r6("distance").alias("distance"), r6("score").alias("score"))


@query("v23_mmr", _MMR_SQL)
def search_mmr(t: Tables):
    """Diverse rows out of the twenty nearest of the index."""
    index, centres = _index(t)
    hits = proven.nearest_proven(index, proven.with_radii(index, centres), t.vector_queries, 20)
    picks = op.mmr_batch(t.vectors, t.vector_queries, 4, 20, 0.5, hits=hits)
    return picks.select("qid", "rank", "id", r6("distance").alias("distance"))


def _quantised(t: Tables):
    model = quantised.train(t.vectors)
    path = scratch_path(t.spark, "quantised-index")
    quantised.write(t.vectors, model, path)
    return t.spark.read.parquet(path), model


@query(
    "v22_quantised_index",
    "SELECT vec_id AS id, 16 AS code_bytes, true AS nearer FROM embeddings",
)
def quantised_index(t: Tables):
    """Every row read back: its code, and whether the coded vector is at least as near to the row as the cell's centre."""
    index, model = _quantised(t)
    shipped = t.spark.sparkContext.broadcast(model)

    def decoded(batches):
        for rows in batches:
            codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
            numbers = rows["cell"].to_numpy()
            yield rows[["id", "code", "embedding"]].assign(
                coded=list(shipped.value.decoded(numbers, codes)), centre=list(shipped.value.centres[numbers])
            )

    schema = "id long, code binary, embedding array<double>, coded array<double>, centre array<double>"
    rows = index.withColumn("embedding", F.col("embedding").cast("array<double>")).mapInPandas(decoded, schema)
    unit = F.transform("embedding", lambda x: x / V.norm(F.col("embedding")))
    nearer = V.l2_distance(unit, F.col("coded")) <= V.l2_distance(unit, F.col("centre")) + 1e-9
    return rows.select("id", F.length("code").alias("code_bytes"), nearer.alias("nearer"))


@query(
    "v23_quantised_recall",
    "SELECT count(*) AS neighbours, true AS nine_of_ten FROM (SELECT 1 FROM embeddings a, range(least(10, (SELECT count(*) FROM embeddings))))",
)
def quantised_recall(t: Tables):
    """Recall at 10 of the quantised search against the exact one, every vector as a query."""
    index, model = _quantised(t)
    found = quantised.search(index, model, t.vector_queries, 10, nprobe=32)
    exact = op.knn_batch(t.vectors, t.vector_queries, 10)
    hits = exact.select("qid", "id").join(found.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left")
    return hits.agg(F.count(F.lit(1)).alias("neighbours"), (F.avg(F.coalesce("hit", F.lit(0))) >= 0.9).alias("nine_of_ten"))
