import hashlib

import pytest
from pyspark.sql import functions as F

from lakeretrieve import stores as S
from lakeretrieve.functions.vectors import hash_embedding
from lakeretrieve.operators import blobs, keyed
from lakeretrieve.plans.changelog import ChangeLog
from lakeretrieve.sources.files import import_directory, import_texts
from lakeretrieve.sources.tables import read_months, write_by_month


def pairs(spark, *rows):
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "ord bigint, key string, value string")


def asked(spark, *keys):
    return spark.createDataFrame(list(enumerate(keys)), "ord bigint, key string")


def values(df, column="value"):
    return [r[column] for r in df.orderBy("ord").collect()]


def keys(df):
    return [r.key for r in df.collect()]


def test_key_value_store(spark, tmp_path):
    store = S.KeyValueStore(spark, str(tmp_path / "kv"))
    assert values(store.mget(asked(spark, "k1"))) == [None]
    store.mset(pairs(spark, ("k1", "a"), ("k2", "b"), ("k3", ""), ("k1", "last")), order="ord")
    assert values(store.mget(asked(spark, "k2", "nope", "k1", "k2", "k3"))) == ["b", None, "last", "b", None]
    store.mdelete(asked(spark, "k1", "k3", "never"))
    assert values(store.mget(asked(spark, "k1", "k2", "k3"))) == [None, "b", None]
    store.mset(pairs(spark, ("k1", "again")))
    assert values(store.mget(asked(spark, "k1"))) == ["again"]
    assert store.mget(asked(spark).limit(0)).count() == 0


def test_prefixes_are_literal(spark, tmp_path):
    store = S.KeyValueStore(spark, str(tmp_path / "kv"))
    store.mset(pairs(spark, ("user:alice:name", "1"), ("user:alice:mail", "2"), ("user:bob:name", "3"), ("post:1", "4"), ("user_x", "5"), ("a%b", "6")))
    assert keys(store.yield_keys("user:")) == ["user:alice:mail", "user:alice:name", "user:bob:name"]
    assert len(keys(store.yield_keys("user:alice:"))) == 2
    assert keys(store.yield_keys("user_")) == ["user_x"]
    assert keys(store.yield_keys("a%")) == ["a%b"]
    assert len(keys(store.yield_keys())) == 6 == len(keys(store.yield_keys("")))


def test_change_log_times_replay_and_compaction(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), {"key": "string"}, {"value": "string"})

    def at(day):
        return F.lit(f"2024-01-{day:02d}").cast("timestamp")

    def live(table):
        return [(r.key, r.value, r.created_at.day, r.updated_at.day) for r in table.current().orderBy("key").collect()]

    log.put(pairs(spark, ("a", "1"), ("b", "1")), ts=at(1))
    log.put(pairs(spark, ("a", "2")), ts=at(2))
    assert live(log) == [("a", "2", 1, 2), ("b", "1", 1, 1)]
    log.delete(asked(spark, "a"), ts=at(3))
    assert live(log) == [("b", "1", 1, 1)]
    batch = log.put(pairs(spark, ("a", "3"), ("b", "3"), ("b", "4")), order="ord", ts=at(4))
    want = [("a", "3", 4, 4), ("b", "4", 1, 4)]
    assert live(log) == want
    # replaying a batch changes nothing
    log.put(pairs(spark, ("a", "3"), ("b", "3"), ("b", "4")), order="ord", ts=at(4), batch=batch)
    assert live(log) == want
    assert live(log.compact(str(tmp_path / "compact"))) == want
    # a null value is a value
    log.put(spark.createDataFrame([("a", None)], "key string, value string"), ts=at(5))
    assert live(log)[0] == ("a", None, 4, 5)


def test_documents(spark, tmp_path):
    store = S.DocumentStore(spark, str(tmp_path / "docs"))
    docs = spark.createDataFrame(
        [("d1", "one", '{"source":"s","processed":true,"tags":["x","y"]}'), ("d2", "two", "broken")],
        "key string, content string, metadata string",
    )
    store.store_documents(docs)
    store.mset(pairs(spark, ("d3", "three")))
    found = store.get_documents(asked(spark, "d3", "d2", "d1", "d0")).orderBy("ord").collect()
    assert [(r.key, r.content, r.metadata) for r in found] == [
        ("d2", "two", "{}"), ("d1", "one", '{"source":"s","processed":true,"tags":["x","y"]}'),
    ]
    assert store.get_documents(asked(spark, "d3"), null_metadata_as_empty=True).first().metadata == "{}"
    assert values(store.mget(asked(spark, "d3", "d9"))) == ["three", None]
    # a plain mset drops the metadata
    store.mset(pairs(spark, ("d1", "new")))
    assert store.get_documents(asked(spark, "d1")).count() == 0


def test_cache_aside(spark):
    inputs = spark.createDataFrame([("a",), ("bb",), ("a",)], "input string")
    key = lambda s: "p:" + hashlib.md5(s.encode()).hexdigest()
    cache = spark.createDataFrame([(key("a"), "cached")], "key string, value string")
    results, fresh = keyed.compute_missing(inputs, cache, lambda c: F.upper(c), prefix="p:")
    assert {(r.input, r.value, r.cached) for r in results.collect()} == {("a", "cached", True), ("bb", "BB", False)}
    assert [(r.key, r.value) for r in fresh.collect()] == [(key("bb"), "BB")]


def test_sessions(spark):
    store = spark.createDataFrame([("session:u1", '{"page":1}'), ("session:u2", "bad")], "key string, value string")
    rows = keyed.session_blobs(spark.createDataFrame([("u1",), ("u2",), ("u3",)], "session_id string"), store)
    assert {r.session_id: r.state for r in rows.collect()} == {"u1": '{"page":1}', "u2": "{}", "u3": "{}"}


@pytest.mark.parametrize("kind,name", [("user", "x"), ("table", None), ("named", ""), ("other", None)])
def test_bad_addresses(spark, tmp_path, kind, name):
    with pytest.raises(ValueError):
        S.FileStore(spark, str(tmp_path), kind, name)
    row = spark.createDataFrame([(kind, name)], "k string, n string")
    assert row.select(blobs.valid_address(F.col("k"), F.col("n"))).first()[0] is False


def test_files(spark, tmp_path):
    store = S.FileStore(spark, str(tmp_path / "files"), "named", "vol", "/sub/")
    files = spark.createDataFrame(
        [("test/a.txt", bytearray(b"hello"), "text/plain"), ("test/b.png", bytearray(b"\x89PNG\r\n"), "image/png"), ("other.json", bytearray(b"{}"), None), ("empty", bytearray(b""), None)],
        "key string, value binary, mime_type string",
    )
    store.store_files(files)
    raw = spark.createDataFrame([("raw", bytearray(b"\x00\xff"))], "key string, value binary")
    store.mset(raw)
    got = {r.key: (bytes(r.value), r.mime_type) for r in store.get_files(asked(spark, "test/a.txt", "other.json", "empty", "none", "raw")).collect()}
    octets = "application/octet-stream"
    assert got == {"test/a.txt": (b"hello", "text/plain"), "other.json": (b"{}", octets), "raw": (b"\x00\xff", octets)}
    back = values(store.mget(asked(spark, "empty", "none", "test/b.png")))
    assert [None if v is None else bytes(v) for v in back] == [b"", None, b"\x89PNG\r\n"]
    assert [(r.key, r["size"], r.mime_type) for r in store.list_files("test/").collect()] == [("test/a.txt", 5, "text/plain"), ("test/b.png", 6, "image/png")]
    store.mdelete(asked(spark, "test/a.txt", "other.json"))
    assert keys(store.yield_keys()) == ["empty", "raw", "test/b.png"]
    path = store.log.current().filter("key = 'raw'").first().file_path
    assert path == "sub/" + hashlib.sha256(b"raw").hexdigest() + ".dat"


def test_directories(spark):
    rows = spark.createDataFrame([("a.dat", 1), ("sub/b.dat", 2), ("sub/deep/c.dat", 3), ("subx/d.dat", 4)], "file_path string, size bigint")
    names = lambda d: [r.file_path for r in blobs.list_directory(rows, d).collect()]
    assert names(None) == ["a.dat"] and names("/sub/") == ["sub/b.dat", "sub/deep/c.dat"]


def test_import_files(spark, tmp_path):
    (tmp_path / "d" / "inner").mkdir(parents=True)
    (tmp_path / "d" / "x.txt").write_text("one\ntwo")
    (tmp_path / "d" / "inner" / "y.bin").write_bytes(b"\x00")
    rows = {r.key: (bytes(r.value), r.mime_type) for r in import_directory(spark, str(tmp_path / "d")).collect()}
    assert rows == {"x.txt": (b"one\ntwo", "text/plain"), "inner/y.bin": (b"\x00", "application/octet-stream")}
    texts = import_texts(spark, str(tmp_path / "d")).collect()
    assert [t.content for t in texts] == ["one\ntwo"] and "x.txt" in texts[0].metadata


def test_large_files_come_in_parts(spark, tmp_path, monkeypatch):
    """No row holds more of a file than a part, and size and MD5 are those of whole files."""
    from lakeretrieve.registry import QUERIES, blobs as registered
    from lakeretrieve.sources import files

    (tmp_path / "in ner").mkdir()
    contents = {"in ner/é%20.parquet": b"abc", "even.parquet": b"12345678", "odd.parquet": bytes(range(256)) * 41 + b"x"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "other.txt").write_text("no")
    (tmp_path / "none.parquet").write_bytes(b"")
    parts = import_directory(spark, str(tmp_path), "*.parquet", 4)
    rows = parts.select("key", "part", "value", "md5").orderBy("key", "part").collect()
    assert max(len(r.value) for r in rows) == 4
    for name, content in contents.items():
        own = [r for r in rows if r.key == name]
        assert b"".join(bytes(r.value) for r in own) == content
        assert own[-1].md5 == hashlib.md5(content).hexdigest()
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]

    expected = {(n, len(c), hashlib.md5(c).hexdigest()) for n, c in contents.items()}
    monkeypatch.setattr(registered, "PART_BYTES", 4)
    for on_disk in (files._on_disk, lambda *_: False):
        monkeypatch.setattr(files, "_on_disk", on_disk)
        found = QUERIES["b13_import_directory"](spark, str(tmp_path))
        assert {(r.key, r["size"], r.value_md5) for r in found.collect()} == expected
        assert found.columns == ["key", "file_path", "mime_type", "size", "value_md5"]


def test_month_folders_prune(spark, tmp_path):
    df = spark.range(400).select("id", F.expr("timestamp'2024-01-01' + make_dt_interval(id)").alias("ts"))
    path = str(tmp_path / "m")
    write_by_month(df, path)
    part = read_months(spark, path, "202402", "202403")
    assert part.count() == 29 + 31
    assert "PartitionFilters: [isnotnull(month" in part._jdf.queryExecution().toString()


def test_vector_store(spark, tmp_path):
    store = S.HybridStore(spark, str(tmp_path / "vs"), lambda c: hash_embedding(c, 16))
    texts = spark.createDataFrame(
        [("湖仓 Lakehouse 支持向量检索", '{"category":"tech"}'), ("全文检索 engine", '{"category":"tech"}'), ("noodle soup", '{"category":"food"}'), ("noodle soup", '{"category":"food"}')],
        "content string, metadata string",
    )
    ids = [r.id for r in store.add_texts(texts).collect()]
    assert len(ids) == 4 and len(set(ids)) == 3
    q = spark.createDataFrame([(1, "noodle soup"), (2, "全文检索 engine")], "qid int, query string")
    rows = store.similarity_search_with_score(q, 1).orderBy("qid").collect()
    # the content id was stored twice: both rows of the one hit come back
    assert [(r.qid, r.content, round(r.score, 6)) for r in rows] == [
        (1, "noodle soup", 1.0), (1, "noodle soup", 1.0), (2, "全文检索 engine", 1.0),
    ]
    assert store.similarity_search(q, 4, {"category": "food"}).select("content").distinct().count() == 1
    vector = store.corpus().filter("content = 'noodle soup'").first().embedding
    assert store.similarity_search_by_vector(vector, 1).first().content == "noodle soup"
    assert store.max_marginal_relevance_search(q, 2, 3).count() >= 4
    for kind in ("vector", "fulltext", "hybrid"):
        assert store.search(q, kind, 2).count() > 0
    store.build_index(2)
    assert {r.qid for r in store.search_index(q, 1, 2).collect()} == {1, 2}
    store.delete(spark.createDataFrame([(ids[2],)], "id string"))
    assert store.corpus().count() == 2
    assert store.search(q, "fulltext", 5).count() == 1
    assert "noodle soup" not in [r.content for r in store.corpus().collect()]
    assert ids[2] not in {r.id for r in store.search_index(q, 5, 2).collect()}
    store.add_texts(spark.createDataFrame([("noodle soup",), ("new text",)], "content string"))
    assert store.corpus().count() == 4
    assert {r.id for r in store.search_index(q, 5, 2).collect()} == {r.id for r in store.corpus().collect()}
    # rows added since widen their cells, so that the proof covers them
    store.build_index(2, {"category": "string"})
    store.add_texts(spark.createDataFrame([(f"soup number {i}", '{"category": "food"}') for i in range(30)], "content string, metadata string"))
    exact = store.similarity_search_with_score(q, 5, {"category": "food"})
    found = store.search_index(q, 5, None, conditions={"category": "food"})
    near = lambda df: sorted((r.qid, round(r.distance, 9)) for r in df.collect())
    assert near(found) == near(exact) and len(near(found)) == 10
    with pytest.raises(ValueError, match="not promoted"):
        store.search_index(q, 5, conditions={"author": "x"})


def test_full_text_store(spark, tmp_path):
    store = S.FullTextStore(spark, str(tmp_path / "ft"))
    docs = spark.createDataFrame([("1", "alpha beta"), ("2", "beta gamma"), ("3", "alpha gamma beta")], "id string, content string")
    store.add_documents(docs)
    store.build_index()
    q = spark.createDataFrame([(1, "alpha beta")], "qid int, query string")
    for use_index in (False, True):
        assert {r.id for r in store.search(q, 5, "all", use_index=use_index).collect()} == {"1", "3"}
        assert {r.id for r in store.search(q, 5, use_index=use_index).collect()} == {"1"}
    store.delete(spark.createDataFrame([("1",)], "id string"))
    assert {r.id for r in store.search(q, 5, "all", use_index=True).collect()} == {"3"}
    # rows added after the index was built are found too, also under an old id
    store.add_documents(spark.createDataFrame([("1", "beta alpha"), ("4", "the alpha beta")], "id string, content string"))
    assert {r.id for r in store.search(q, 5, "all", use_index=True).collect()} == {"1", "3", "4"}
    assert {r.id for r in store.search(q, 5, use_index=True).collect()} == {"4"}
    store.build_index()
    assert {r.id for r in store.search(q, 5, "any", use_index=True).collect()} == {"1", "2", "3", "4"}


def test_scratch_is_dropped(spark):
    import os

    from lakeretrieve.session import drop_scratch, materialise

    df = materialise(spark.range(10), "numbers")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert df.count() == 10 and os.path.isdir(folder)
    drop_scratch(spark)
    assert not os.path.exists(folder)
