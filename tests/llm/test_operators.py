"""Each operator on small rows: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from public_tokenizers import path as vocabulary_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeretrieve.llm import importance, licenses, line_dedup, mixing, near_copies, packing, quality_rules, secrets, simhash, site_quality, syncmers, token_store, tokens
from lakeretrieve.llm.queries import ORACLES, QUERIES
from tests.oracle import _plain, connection

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvwy") for _ in range(r.randint(2, 9))) for _ in range(n))


LONG = prose(1, 40_000)
ROWS = [
    (1, prose(2, 120), "en", "a", 1),
    (2, prose(2, 120), "en", "a", 1),
    (2, prose(3, 80) + "\n" + prose(2, 120), "en", None, 1),
    (None, prose(4, 70), None, "b", None),
    (None, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, LONG, "en", "b", 0),
    (7, "Tiny.", "en", "b", 0),
]


def importance_kept(docs):
    return importance.drawn(docs, docs, percent=50)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert _plain(ours) == _plain(connection(SF_DIR).execute(ORACLES[name]).df())


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_empty_tables(nothing, labels):
    none = labels.limit(0)
    results = [
        licenses.with_licenses(nothing),
        token_store.read_tokens(token_store.write_tokens(nothing, vocabulary_path("word_bpe_49k.json"), 2)),
        line_dedup.dedup_lines(nothing),
        simhash.near_duplicates(nothing),
        simhash.keep_one(nothing),
        syncmers.fingerprints(nothing),
        site_quality.rated(nothing.withColumnsRenamed({"source": "host", "lang": "path"}), none),
        packing.packed(nothing, vocabulary_path("byte_bpe_50k.json"), 0),
        mixing.mix(nothing),
        secrets.with_secrets(nothing, secrets.train(nothing)),
        quality_rules.judged(nothing, none),
        quality_rules.keep_good(nothing, labels),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_license_base_places_and_suppression(docs):
    found = licenses.scan("Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: GPL-2.0-only".encode())
    assert found[:6] == (15, 1, 3, 3, "apache", "apache,gpl")
    assert [d[0] for d in found[7]] == ["apache", "gpl"]
    assert licenses.scan("CC BY, cc by; MITlicense mit license".encode())[:5] == (7, 3, 0, 5, "cc-by,mit")
    assert licenses.scan(None)[:6] == (0, 0, None, None, "", "")
    assert len(licenses.rules()) >= 200
    clashing = docs.withColumn("labels", F.lit("x"))
    assert {r["labels"] for r in licenses.with_licenses(clashing).collect()} == {""}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunked_ids_equal_whole_ids(name):
    whole, chunked = Tokenizer.from_file(vocabulary_path(name)), tokens.Encoder(vocabulary_path(name))
    r = random.Random(3)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "1", "ß", "İ", "!", "...", "\xa0", "́", "日本", "\x0b", "\x1c", " \n ", "<|endoftext|>", "Á", "|"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert np.frombuffer(chunked.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 2**31, 2**64 - 1])
def test_segments_round_trip(top):
    for n in (0, 1, 8191, 8193, 20_000):
        ids = np.random.default_rng(n).integers(0, top, n, np.uint64)
        assert (token_store.decode_segment(token_store.encode_segment(ids)) == ids).all()
    ids = np.arange(20_000, dtype=np.uint64)
    assert (token_store.decode_segment(token_store.encode_segment(ids), 1, 2) == ids[8192:16384]).all()


def test_token_store(docs):
    read = token_store.read_tokens(token_store.write_tokens(docs, vocabulary_path("word_bpe_49k.json"), 2)).collect()
    whole, at = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json")), 0
    expected = []
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, read), key=lambda r: r[1]) == expected


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_distance(spark, most):
    r, pairs = random.Random(most), []
    while len(pairs) < 800:
        a = [r.choice("abé") for _ in range(r.randint(6, 14))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            b[r.randint(0, len(b) - 1) :][:1] = [r.choice("abé")] * r.randint(0, 2)
            at = r.randint(0, len(b) - 1)
            b[at : at + 1] = [r.choice("abé")] * r.randint(0, 2) or ["a"]
        if abs(len(a) - len(b)) <= most and len(b) > most:
            pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select(line_dedup.edit_distance(F.col("a"), F.col("b"), most).alias("d"), F.levenshtein("a", "b").alias("l")).collect()
    assert all(x["d"] == x["l"] for x in rows if min(x) <= most)


@pytest.mark.parametrize("edits", [1, 2])
def test_line_links_are_complete(spark, edits):
    r, lines = random.Random(9), []
    for i in range(40):
        line = prose(i, 5)
        lines.append(line)
        for _ in range(3):
            changed = list(line)
            for _ in range(r.randint(1, 3)):
                changed[r.randint(0, len(changed) - 1)] = r.choice("abcz")
            if r.random() < 0.5:
                changed.insert(r.randint(0, len(changed)), "q")
            lines.append("".join(changed))
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    found = line_dedup.line_links(docs, line_dedup.distinct_lines(docs, edits, 5), edits, 5).count()
    both = docs.selectExpr("text a").distinct().join(docs.selectExpr("text b").distinct(), F.levenshtein("a", "b") <= edits)
    assert found == both.where("a < b").count() > 0


def test_dedup_lines(docs):
    clashing = docs.withColumn("line_counts", F.lit("x"))
    done = line_dedup.dedup_lines(clashing).collect()
    assert len(done) == len(ROWS)
    by_id = {(r["doc_id"], r["source"]): r["text"] for r in done}
    assert by_id[(1, "a")] == prose(2, 120) and by_id[(2, "a")] == ""
    assert by_id[(2, None)] == prose(3, 80) and by_id[(7, "b")] == "Tiny." and by_id[(None, None)] is None and by_id[(6, "b")] == LONG


def test_simhash_against_all_pairs(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(60)]
    prints = base + [b ^ (1 << r.randint(0, 63)) ^ (1 << r.randint(0, 63)) ^ (1 << r.randint(0, 63)) ^ (1 << r.randint(0, 63)) * r.randint(0, 1) for b in base for _ in range(5)]
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    found = simhash.components(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    got = {r["print_fp"]: r["component_id"] for r in found}
    assert [got[fp] for _, fp in rows] == [find(i) for i in range(len(prints))]


def test_blocks_of_a_crowded_bucket(spark):
    rows = [(int(i),) for i in range(64)]
    nodes = spark.createDataFrame(rows, "fp long")
    roots = simhash.connected_components(simhash.links(nodes, 3, block=8)).select("root").distinct().collect()
    assert [r["root"] for r in roots] == [0]


def test_fingerprints(docs):
    got = simhash.near_duplicates(docs).collect()
    words = re.split(" ", prose(2, 120))
    counts = [0] * 64
    for i in range(118):
        h = xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42)
        counts = [c + (h >> b & 1) for b, c in enumerate(counts)]
    expected = sum(1 << b for b, c in enumerate(counts) if 2 * c > 118)
    assert {r["fingerprint"] for r in got if r["doc_id"] == 1} == {f"{expected:016x}"}
    assert {r["component_id"] for r in got if r["doc_id"] == 5} == {5}
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len({r["component_id"] if r["component_id"] is not None else r["fingerprint"] for r in got})


def test_syncmers(docs):
    got = syncmers.fingerprints(docs).collect()
    assert len(got) == len(ROWS)
    same = {r["fingerprint"] for r in got if r["doc_id"] == 1}
    assert len(same) == 1 and next(iter(same)) in {r["fingerprint"] for r in got if r["doc_id"] == 2}
    long_one = next(r for r in got if r["doc_id"] == 6)
    assert long_one["near_edited"] > 0.6 and long_one["near_next"] < 0.1
    text = prose(8, 400)
    places, hashes = syncmers.syncmers(text)
    moved, again = syncmers.syncmers("xyz " + text)
    assert set(zip((places + 4).tolist(), hashes.tolist())) <= set(zip(moved.tolist(), again.tolist()))


def test_site_quality_shrinks_sparse_sites(spark):
    rows = [(i, "big", "x", 1.0 if i % 10 else 0.0) for i in range(200)] + [(500, "small", "x", 0.5)] + [(600 + i, None, None, 0.05) for i in range(60)]
    got = {r["doc_id"]: r for r in site_quality.posteriors(spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")).collect()}
    overall = sum(r[3] for r in rows) / len(rows)
    assert abs(got[500]["path_rate"] - overall) < 0.01 and got[600]["path_rate"] < overall < got[1]["path_rate"]


def test_site_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "text", "source host", "lang path")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    held = labels.join(seen.select("doc_id"), "doc_id", "left_anti")
    right = site_quality.rated(docs, seen).join(held, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.95


def test_packing(docs):
    r = random.Random(6)
    for _ in range(60):
        histogram = {r.randint(1, 100): r.randint(1, 4) for _ in range(r.randint(1, 25))}
        held = Counter()
        for pattern, times in packing.pack(histogram, 100):
            assert sum(pattern) <= 100
            for x in pattern:
                held[x] += times
        assert held == Counter(histogram)
    assert sum(n for _, n in packing.pack({60: 3, 40: 3, 50: 4, 25: 4}, 100)) == 6
    got = packing.packed(docs, vocabulary_path("byte_bpe_50k.json"), 0).toPandas()
    assert sum(got["length"]) == sum(len(Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")).encode(x[1] or "").ids) + 1 for x in ROWS)
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert (rows["length"].cumsum() - rows["length"] == rows["offset"]).all() and rows["length"].sum() <= 2048


def test_targets_stop_at_three_times():
    assert mixing.targets({"a": 1000, "b": 10, None: 90}) == {"a": 800.0, "b": 30.0, None: 270.0}
    assert mixing.targets({"a": 0}) == {"a": 0.0}


def test_mixing(docs):
    taken = mixing.copies(docs.select("doc_id", "source", mixing.size_of("text").alias("size")), "doc_id").collect()
    assert len(taken) == len(ROWS) and all(0 <= r["copies"] <= 3 for r in taken)
    again = [Counter(map(tuple, mixing.mix(docs).select("doc_id", "source").collect())) for _ in range(2)]
    assert again[0] == again[1] and mixing.mix(docs).columns == docs.columns


def test_secret_spans(spark):
    text = 'é password: "hunter22" token=ab SECRET = abcdef AKIA' + "A" * 16 + " " + "0f" * 12 + " token: secret: abcdefgh"
    row = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: [(s["ord"], s["start"], s["end"]) for s in r["base"]] for r in secrets.with_secrets(row.withColumn("base", F.lit(1)), None).collect()}
    expected = [(k, m.start(), m.end()) for k, p, n in ((0, secrets.ASSIGN, 6), (1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)) for m in re.finditer(p, text) if len(m[2] if k == 0 else m[0]) >= n]
    assert got == {1: sorted(expected, key=lambda s: (s[1], s[0])), 2: [], 3: []}


def test_random_strings_are_told_from_words(spark):
    r = random.Random(2)
    rows = [(i, prose(i, 60) + " token = " + "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(docs)
    tried = spark.createDataFrame([("9f3k2q8z7x1v5b0n4m6j",), ("configurationmanagers",)], "token string")
    random_one, word = [x[0] for x in tried.select(model.score(F.col("token"))).collect()]
    assert random_one > word


def test_statistics_against_brute_force(docs):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for row in quality_rules.with_statistics(docs.withColumn("n_words", F.lit("x")).withColumn("copy", F.col("text"))).collect():
        text = row["copy"] or ""
        found, places = word.findall(text), {}
        for i in range(len(found) - 2):
            places.setdefault(tuple(found[i : i + 3]), []).append(i)
        covered = {j for at in places.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if word.search(x)]
        counts = (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert tuple(row[c] for c in quality_rules.COUNTS) == counts


def test_rules_are_learned(spark):
    rows = [(i, prose(i, 60) if i % 5 else " ".join(w + "$$$" for w in prose(i, 60).split())) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(200)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality_rules.judged(docs, labels).where("kept").collect()}
    assert kept == {i for i in range(300) if i % 5}
    assert {r["doc_id"] for r in quality_rules.keep_good(docs, labels).collect()} == kept


@pytest.mark.parametrize("stage", [mixing.mix, near_copies.keep_one, importance_kept], ids=["mix", "keep_one", "drawn"])
def test_stages_with_clashing_columns(docs, stage):
    names = ["copies", "__taken", "__row", "__copy", "__times", "__of", "__kept", "node", "at", "root", "row", "key", "first", "position", "size", "plan_source"]
    clashing = docs.select("*", *[F.lit("x").alias(n) for n in names])
    got = stage(clashing)
    assert got.columns == clashing.columns
    own = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)
    assert own(got) == own(stage(docs))
    assert {r["node"] for r in got.collect()} <= {"x"}
