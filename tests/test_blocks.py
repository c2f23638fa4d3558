"""Block postings: size, decoding, plans and rows of equal ids."""

import os
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeretrieve.plans import blocks
from lakeretrieve.plans.postings import build_postings, query_terms, write_postings

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def _bytes(folder):
    return sum(
        os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    )


def _corpus(spark, rows):
    return spark.createDataFrame(rows, "id long, content string")


def _queries(spark, rows):
    return spark.createDataFrame(rows, "qid int, query string")


def _found(index, queries, k, mode):
    return sorted((r.qid, r.id) for r in blocks.search_index(index, queries, k, mode).collect())


def _matches(words, asked, mode):
    if mode == "any":
        return bool(set(words) & set(asked))
    if mode == "all":
        return bool(asked) and set(asked) <= set(words)
    return bool(asked) and any(words[i : i + len(asked)] == asked for i in range(len(words)))


def test_index_is_smaller_than_plain_postings(spark, tmp_path):
    corpus = spark.read.parquet(DOCUMENTS).select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    write_postings(build_postings(corpus), str(tmp_path / "plain"), buckets=8, salts=2)
    blocks.write_index(corpus, str(tmp_path / "blocks"))
    assert _bytes(tmp_path / "blocks") < _bytes(tmp_path / "plain")


def test_random_texts_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "SLICE_DOCUMENTS", 7)
    draw = random.Random(5)
    letters = "a a a a b b c d e f".split()
    # Rows of equal ids, equal rows, null and empty texts, and one long text.
    rows = [(i // 2, " ".join(draw.choices(letters, k=draw.randint(0, 9)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "a b"), (502, "a b"), (503, "a " * 20000 + "z")]
    asked = ["a", "a a", "b a b", "d e", "f f f", "z", "c missing", "", "a b c"]
    index = blocks.write_index(_corpus(spark, rows), str(tmp_path / "i"))
    queries = _queries(spark, list(enumerate(asked)))
    for mode in ("phrase", "all", "any"):
        wanted = sorted(
            (n, id_) for n, q in enumerate(asked) for id_, text in rows if text and _matches(text.split(), q.split(), mode)
        )
        assert _found(index, queries, None, mode) == wanted
        first = [[w for w in wanted if w[0] == n][:3] for n in range(len(asked))]
        assert _found(index, queries, 3, mode) == sorted(sum(first, []))
    stored = sorted(tuple(r) for r in index.postings().filter("id < 500").collect())
    assert stored == sorted((w, i, p) for i, t in rows if t and i < 500 for p, w in enumerate(t.split()))
    counts = {r.term: (r.documents, r.occurrences) for r in index.terms.collect()}
    assert counts["z"] == (1, 1)
    assert counts["b"][1] == sum((t or "").split().count("b") for _, t in rows)


def test_empty_corpus_and_no_queries(spark, tmp_path):
    empty = blocks.write_index(_corpus(spark, []), str(tmp_path / "none"))
    full = blocks.write_index(_corpus(spark, [(1, "a b")]), str(tmp_path / "one"))
    for mode in ("phrase", "all", "any"):
        assert _found(empty, _queries(spark, [(1, "a")]), 4, mode) == []
        assert _found(full, _queries(spark, []), 4, mode) == []


def test_other_lists_are_cut_before_they_are_shuffled(spark, tmp_path):
    rows = [(i, "common common" + (" rare" if i % 500 == 0 else "")) for i in range(4000)]
    index = blocks.write_index(_corpus(spark, rows), str(tmp_path / "i"))
    terms = query_terms(_queries(spark, [(1, "common rare")]))
    base, doc = index.blocks.filter("term = 'common'").select("base", F.col("docs")[0] + F.col("base")).first()
    lookups = spark.createDataFrame([("common", base, doc)], "term string, base long, doc long")
    kept = blocks.other_places(index.blocks, lookups, terms, 2, ["common", "rare"], True)
    assert [(r.term, r.doc, r.pos) for r in kept.orderBy("pos").collect()] == [("common", doc, 0), ("common", doc, 1)]
    # The filter lets one of the term's blocks through, before the join on the slice.
    key, bits = ["term", "base"], blocks.filter_bits(1)
    near = blocks.may_hold(index.blocks, key, blocks.candidate_filter(lookups, key, bits), bits)
    assert near.count() == 1 < index.blocks.filter("term = 'common'").count()
    plan = near._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.split("\n")) if "docs#" in line and "FileScan" in line)
    above = plan.split("\n")[:scan]
    assert any("BroadcastHashJoin" in line for line in above) and not any("Exchange hash" in line for line in above)
    assert _found(index, _queries(spark, [(1, "common rare")]), None, "phrase") == [(1, i) for i in range(0, 4000, 500)]


def test_scan_is_pruned_by_term(spark, tmp_path):
    index = blocks.write_index(_corpus(spark, [(1, "a b c")]), str(tmp_path / "i"))
    terms = query_terms(_queries(spark, [(1, "b")]))
    rows = blocks._of_terms(index.blocks, terms, 1, ["b"]).select("docs")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,b)" in plan and "positions" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_decoded_row_is_shuffled_for_its_id(spark, tmp_path):
    """Ids come to whole blocks, however large the table of documents is."""
    corpus = spark.createDataFrame([(i // 2, f"a b{i % 3} a") for i in range(40)] + [(None, "a c")], "id long, content string")
    index = blocks.write_index(corpus, str(tmp_path / "index"))
    found = index.postings()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan
    expected = Counter((t, i, p) for i, text in corpus.collect() for p, t in enumerate(text.split()))
    assert Counter(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("mode", ["phrase", "all"])
def test_candidates_are_not_broadcast(spark, tmp_path, mode):
    """Their files are tiny beside their rows, so Spark would; only their bit map is."""
    corpus = _corpus(spark, [(i, "a b c " + "x " * (i % 3)) for i in range(60)])
    index = blocks.write_index(corpus, str(tmp_path / "index"))
    found = blocks.search_index(index, _queries(spark, [(1, "a b c"), (2, "c x"), (3, "x x")]), None, mode)
    lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    shipped = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            shipped.append("\n".join(lines[i:end]))
    assert any("bitmap_construct_agg" in part for part in shipped)
    for part in shipped:
        assert "bitmap_construct_agg" in part or "lookups-" not in part and "index/documents" not in part
    expected = {(1, i) for i in range(60)} | {(2, i) for i in range(60) if i % 3} | {(3, i) for i in range(60) if i % 3 > (mode == "phrase")}
    assert {(r.qid, r.id) for r in found.collect()} == expected


def test_an_index_leaves_nothing_but_itself(spark, tmp_path, monkeypatch):
    """Neither the texts and blocks it is made from nor their shuffles stay on disk."""
    monkeypatch.setattr(blocks, "scratch_path", lambda _, name: str(tmp_path / "scratch" / name))
    spark.conf.unset("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {str(f) for f in (local.getAllFiles().apply(i).getName() for i in range(local.getAllFiles().size())) if f.startswith("shuffle")}

    before = shuffled()
    index = blocks.write_index(_corpus(spark, [(i, f"a b{i}") for i in range(50)]), str(tmp_path / "index"))
    assert os.listdir(tmp_path / "scratch") == []
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert index.postings().count() == 100 and index.terms.count() == 51


@pytest.mark.parametrize("repeated", [False, True])
def test_counts_are_those_of_the_postings(spark, tmp_path, monkeypatch, repeated):
    """Ids with several documents, also across slices, are added up; without any, no counted row is shuffled."""
    monkeypatch.setattr(blocks, "SLICE_DOCUMENTS", 3)
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices("abcdee", k=draw.randint(0, 8)))) for i in range(80)] + [(200, None), (None, "a b a")]
    if repeated:
        rows += [(7, "a a"), (None, "b"), *[(40, "a b c")] * 20, (200, "e")]
    index = blocks.write_index(_corpus(spark, rows), str(tmp_path / "index"))
    places = {}
    for id_, text in rows:
        for at, word in enumerate((text or "").split()):
            places.setdefault((word, id_), []).append(at)
    expected = {(*key, len(p), min(p), max(p), sum(p)) for key, p in places.items()}
    found = index.counts()
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(expected) and set(got) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("hashpartitioning(term" in plan) == repeated


def test_no_slice_reaches_into_another_files_numbers():
    docs = np.array([5, 6, 1 << blocks.NUMBER_BITS, (1 << blocks.NUMBER_BITS) + 1])
    batch = pa.record_batch({"doc": pa.array(docs), "tokens": pa.array([["a"]] * 4)})
    made = list(blocks._to_blocks(iter([batch])))
    assert [(b.column("base").to_pylist(), b.column("docs").to_pylist()) for b in made] == [([5], [[0, 1]]), ([1 << blocks.NUMBER_BITS], [[0, 1]])]
