"""The Jaccard join against all pairs, and its keys against random linked sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeretrieve.llm import ngram_join
from tests.llm.test_operators import LONG, prose


def _expected(rows, width=4, num=85, den=100):
    lower = lambda t: "".join(c.lower() if c < "\x80" else c for c in t or "")
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w] for _, t in rows]
    sets = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in least.items()}
    return sorted(((d, len(s), smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def _near_copies(seed, groups=25, each=6):
    """Groups of texts a few words apart, around the threshold, a third of which also share a passage."""
    r, rows, passage = random.Random(seed), [], prose(99, 60)
    for i in range(groups):
        text = prose(1000 + i, r.randint(20, 160)).split()
        for j in range(each):
            changed = list(text)
            for _ in range(r.randint(0, 5)):
                changed[r.randrange(len(changed))] = r.choice(["x", "yy", "zzz"])
            rows.append((100 * i + j, " ".join([*changed, passage] if i % 3 else changed)))
    return rows


ODD_ROWS = [
    (None, None), (9000, ""), (9001, " \t\n"), (9002, "two words"), (9003, "TWO\x0bwords"), (9004, "ÀB cd Éf"), (9005, "àb cd éf"),
    (9006, LONG), (9007, LONG + " one more"), (9010, prose(7, 1020)), (9011, prose(7, 1020) + prose(8, 60)), (9012, prose(7, 1020) + prose(9, 400)), (9008, "a b c d"), (9008, "a b c d"), (None, "a b c d"), (None, "only nulls here at last"),
]


@pytest.mark.parametrize("crowded", [4096, 3])
def test_equals_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    monkeypatch.setattr(ngram_join, "BLOCK", crowded)
    rows = ODD_ROWS + _near_copies(crowded)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.components(docs)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == _expected(rows)
    assert len({c for _, _, c in found}) < len(rows) - 25


def test_files_and_clashing_columns(spark, tmp_path):
    rows = ODD_ROWS + _near_copies(1, 8)
    names = ["row", "fp", "n", "keys", "key", "node", "root", "least", "a", "b", "p0", "_metadata", "component_id", "blocks"]
    plain = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plain.write.parquet(str(tmp_path / "plain"))
    clashing = plain.select("*", *[F.lit("x").alias(c) for c in names])
    for docs in (spark.read.parquet(str(tmp_path / "plain")), clashing):
        assert sorted(map(tuple, ngram_join.components(docs).collect()), key=str) == _expected(rows)
    other = ngram_join.components(spark.read.parquet(str(tmp_path / "plain")), 5, 80, 100)
    assert sorted(map(tuple, other.collect()), key=str) == _expected(rows, 5, 80)
    assert ngram_join.components(plain.limit(0)).count() == 0


@pytest.mark.parametrize("num, den", [(85, 100), (80, 100), (60, 100)])
def test_linked_sets_share_a_key(num, den):
    """Loads that put tokens of one set in all three orders, prefixes of combinations included."""
    r = np.random.default_rng(num)
    for _ in range(400):
        loads = r.choice([0, 10, 100, 1000], ngram_join.COUNTERS, p=r.dirichlet(np.ones(4)))
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**64, n, np.uint64))
        limit = len(a) * (den - num) // (den + num)  # half of what two sets may differ in
        gone, new = int(r.integers(0, limit + 1)), int(r.integers(0, limit + 1))
        b = np.unique(np.concatenate([a[gone:], r.integers(0, 2**64, new, np.uint64)]))
        both = len(np.intersect1d(a, b))
        if den * both < num * (len(a) + len(b) - both) or len(a) == len(b) == both:
            continue
        keys = [ngram_join.prefix_keys(x, loads, [50.0, 500.0], num, den) for x in (a, b)]
        assert len(np.intersect1d(*keys))
        assert max(map(len, keys)) <= (8 if num >= 80 else 40) * n


def test_parities_bound_the_difference():
    r = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**64, int(r.integers(0, 900)), np.uint64))
        b = np.unique(np.concatenate([a[int(r.integers(0, 50)) :], r.integers(0, 2**64, int(r.integers(0, 50)), np.uint64)]))
        for width in (512, 1024):
            bits = np.bitwise_count((ngram_join.parities(a, width) ^ ngram_join.parities(b, width)).view(np.uint64)).sum()
            assert bits <= len(np.setxor1d(a, b))
        low, high = np.split(ngram_join.parities(a, 1024), 2)
        assert (low ^ high == ngram_join.parities(a, 512)).all()
