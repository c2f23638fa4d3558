import pytest
from pyspark.sql import functions as F

from lakeretrieve.functions import metadata as M, text as X
from lakeretrieve.functions.sqlfuncs import register
from lakeretrieve.operators import fulltext as op, hybrid
from lakeretrieve.plans import postings as P


def tokens(spark, text, analyzer="unicode"):
    return spark.createDataFrame([(text,)], "t string").select(X.tokenize(F.col("t"), analyzer)).first()[0]


CASES = [
    ("Hello, World-2x!", "unicode", ["hello", "world", "2x"]),
    ("Hello", "standard", ["hello"]),
    ("The cat AND the dog", "english", ["cat", "dog"]),
    ("Whole String, kept", "keyword", ["Whole String, kept"]),
    ("", "keyword", []),
    ("", "unicode", []),
    ("?!", "unicode", []),
    ("数据abc湖仓", "unicode", ["数", "据", "abc", "湖", "仓"]),
    ("数据湖abc仓", "chinese", ["数据", "据湖", "abc", "仓"]),
    ("数据 Lake", "ik", ["数据", "lake"]),
    ("x", "no such analyzer", ["x"]),
]


@pytest.mark.parametrize("text,analyzer,want", CASES)
def test_tokenize(spark, text, analyzer, want):
    assert tokens(spark, text, analyzer) == want
    register(spark)
    row = spark.sql("SELECT tokenize(:t, map('analyzer', :a))", args={"t": text, "a": analyzer}).first()
    assert row[0] == want


def test_tokenize_null(spark):
    assert tokens(spark, None) is None
    assert tokens(spark, None, "keyword") is None


DOCS = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "quick fox brown"),
    (3, "Brown fox, quick fox. The brown fox is quick"),
    (4, "nothing here"),
    (5, ""),
    (6, None),
    (7, "fox"),
    (8, "fox fox fox"),
    (9, "数据湖仓 supports fox"),
]
QUERIES = [(1, "brown fox"), (2, "fox quick"), (3, "unknown fox"), (4, "FOX"), (5, "?!"), (6, "the the"), (7, "fox fox"), (8, "湖仓"), (9, "brown fox is quick")]


def expected(mode, query, text):
    import re

    def split(s):
        return re.findall(r"[一-鿿]|[^\W_一-鿿]+", (s or "").lower())

    q, t = split(query), split(text)
    if not q:
        return False
    if mode == "phrase":
        return any(t[i:i + len(q)] == q for i in range(len(t) - len(q) + 1))
    return set(q) <= set(t) if mode == "all" else bool(set(q) & set(t))


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(DOCS, "id bigint, content string").withColumn("metadata", F.lit("{}")).cache()


@pytest.mark.parametrize("mode", ["phrase", "all", "any"])
def test_scan_batch_and_index_agree(spark, corpus, tmp_path, mode):
    want = {(q, d) for q, query in QUERIES for d, text in DOCS if expected(mode, query, text)}
    scan = {(q, r.id) for q, query in QUERIES for r in op.matching(corpus, query, mode).collect()}
    assert scan == want
    queries = spark.createDataFrame(QUERIES, "qid int, query string")
    assert {(r.qid, r.id) for r in op.search_batch(corpus, queries, None, mode).collect()} == want
    path = str(tmp_path / "postings")
    P.write_postings(P.build_postings(corpus), path, buckets=4, salts=2)
    stored = spark.read.parquet(path)
    assert {(r.qid, r.id) for r in P.search_postings(stored, queries, None, mode, buckets=4).collect()} == want
    top = P.search_postings(stored, queries, 2, mode).collect()
    for q, _ in QUERIES:
        assert sorted(r.id for r in top if r.qid == q) == sorted(d for x, d in want if x == q)[:2]


def test_sql_match_functions(spark, corpus):
    register(spark)
    corpus.createOrReplaceTempView("match_docs")
    for mode in ("phrase", "all", "any"):
        for _, query in QUERIES:
            rows = spark.sql(
                f"SELECT id FROM match_docs WHERE match_{mode}(content, :q, map('analyzer', 'unicode'))", args={"q": query}
            ).collect()
            assert {r.id for r in rows} == {d for d, text in DOCS if expected(mode, query, text)}


def test_mode_names():
    assert [X.match_mode(m) for m in ("phrase", "boolean", "all", "natural", "ANY", "bogus")] == [
        "phrase", "all", "all", "any", "any", "phrase",
    ]


def test_search_is_ordered_and_scored(corpus):
    rows = op.search(corpus, "fox", 3, "any").collect()
    assert [(r.id, r.score) for r in rows] == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_metadata_parsing(spark):
    texts = ['{"a":1}', "", "broken", None, '{"a":1}}', '{"a":1}]', "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    got = [r[0] for r in df.select(M.clean_metadata(F.col("m"))).collect()]
    assert got == ['{"a":1}', "{}", "{}", "{}", "{}", "{}", "[1]"]
    assert [r[0] for r in df.select(M.parse_metadata(F.col("m")).cast("string")).collect()] == got
    assert [r[0] for r in df.select(M.metadata_text(F.col("m"))).collect()] == [t if t is not None else "{}" for t in texts]


def test_add_and_delete(spark, corpus):
    index = P.build_postings(corpus)
    new = spark.createDataFrame([(20, "a new fox", "{}")], "id bigint, content string, metadata string")
    grown, index = op.add_documents(corpus, index, new)
    left, index = op.delete_documents(grown, index, spark.createDataFrame([(1,), (99,)], "id bigint"))
    q = spark.createDataFrame([(1, "fox")], "qid int, query string")
    assert {r.id for r in P.search_postings(index, q, None, "any").collect()} == {2, 3, 7, 8, 9, 20}
    assert left.count() == len(DOCS)


def sides(spark):
    v = spark.createDataFrame([(1, "a", 0.8, 1), (1, "b", 0.4, 2), (1, "c", -0.2, 3)], "qid int, id string, score double, rank int")
    t = spark.createDataFrame([(1, "b", 1.0, 1), (1, "d", 1.0, 2)], "qid int, id string, score double, rank int")
    return v, t


def test_fusion(spark):
    v, t = sides(spark)
    rows = hybrid.fuse(v, t, 10, 0.5).orderBy("rank").collect()
    assert [(r.id, r.hybrid_score) for r in rows] == [("b", 0.75), ("a", 0.5), ("d", 0.5), ("c", -0.125)]
    # equal scores: the side named first leads
    rows = hybrid.fuse(v, t, 10, 0.5, first="text").orderBy("rank").collect()
    assert [r.id for r in rows] == ["b", "d", "a", "c"]
    assert [r.id for r in hybrid.fuse(v, t, 2, 1.0).orderBy("rank").collect()] == ["a", "b"]
    assert [r.id for r in hybrid.fuse(v, t, 2, 0.0).orderBy("rank").collect()] == ["b", "d"]


def test_fusion_without_positive_scores(spark):
    v = spark.createDataFrame([(1, "a", -0.5, 1), (1, "b", -0.7, 2)], "qid int, id string, score double, rank int")
    t = v.limit(0)
    rows = hybrid.fuse(v, t, 5, 1.0).orderBy("rank").collect()
    assert [(r.id, r.hybrid_score) for r in rows] == [("a", -0.5), ("b", -0.7)]


def test_cross_table_keys(spark):
    vectors = spark.createDataFrame(
        [("v1", "red apple", '{"document_id":"t1"}', [1.0, 0.0]), ("v2", "green pear", "{}", [0.9, 0.3])],
        "id string, content string, metadata string, embedding array<double>",
    )
    texts = spark.createDataFrame(
        [("t1", "red apple", "{}"), ("t2", "green pear", "{}")], "id string, content string, metadata string"
    )
    q = spark.createDataFrame([(1, "apple pear", [1.0, 0.0])], "qid int, query string, qvector array<double>")

    def run(fuse_on):
        rows = hybrid.cross_table_search(vectors, texts, q, 10, mode="any", fuse_on=fuse_on).orderBy("rank").collect()
        return [(r.id, r.vector_score > 0, r.fulltext_score > 0) for r in rows]

    assert run("content") == [("v1", True, True), ("v2", True, True)]
    # without a document_id the same text stays two documents
    assert sorted(run("reference")) == sorted([("v1", True, True), ("v2", True, False), ("t2", False, True)])
    assert len(run("id")) == 4


def test_search_types_and_filter(spark, corpus):
    docs = corpus.filter("content is not null").withColumn("embedding", F.array(F.col("id").cast("double"), F.lit(1.0)))
    docs = docs.withColumn("metadata", F.to_json(F.struct((F.col("id") % 2).alias("odd"))))
    q = spark.createDataFrame([(1, "brown fox", [1.0, 1.0])], "qid int, query string, qvector array<double>")
    text = hybrid.retrieve(docs, q, "fulltext", 4)
    assert {r.id for r in text.collect()} == {1, 3}
    assert hybrid.retrieve(docs, q, "vector", 3).count() == 3
    assert hybrid.retrieve(docs, q, "whatever", 4).orderBy("rank").first().id == 1
    odd = hybrid.hybrid_search(docs, q, 20, mode="any", conditions={"odd": 1}).collect()
    assert {r.id for r in odd} == {1, 3, 5, 7, 9}
    assert {r.strategy for r in hybrid.compare_strategies(docs, q, 2).collect()} == {"semantic", "keyword", "hybrid"}
