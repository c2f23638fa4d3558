from lakeretrieve.llm import ngram_join


def test_keys_of_the_same_nodes_are_compared_once(spark):
    groups = [(range(50), (1, 2, 3)), (range(50, 60), (1, 2)), (range(60, 61), (2, 3)), (range(61, 64), (4, 5, 6))]
    mixed = spark.createDataFrame([(k, fp, fp) for keys, fps in groups for k in keys for fp in fps], "key long, fp long, root long")
    found = sorted((r["of"], r["n"]) for r in ngram_join._distinct_keys(mixed).collect())
    assert found == [(0, 3), (50, 2), (60, 2), (61, 3)]


def test_long_texts_that_share_a_passage_make_no_pairs(spark):
    """Narrow parities of sets this long tell nothing, so wide ones have to."""
    import numpy as np

    own = {i: np.random.default_rng(i).integers(0, 2**63, 4000, np.uint64) for i in range(6)}
    sets = {i: np.unique(np.concatenate([own[i], own[5][:200]])) for i in range(5)} | {5: np.unique(np.append(own[0][:-20], own[5][:200]))}
    names = ", ".join(f"{p} long" for p in ngram_join.PARITIES)
    rows = [(i, len(s), *ngram_join.parities(s).tolist(), ngram_join.wide_parities(s).tolist()) for i, s in sets.items()]
    nodes = spark.createDataFrame(rows, f"fp long, n long, {names}, wide array<long>")
    mixed = spark.createDataFrame([(k, fp, fp) for k in range(100) for fp in sets], "key long, fp long, root long")
    pairs = ngram_join._rest_pairs(mixed, nodes, 85, 100)
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [(0, 5)]


def _met_pairs(rows):
    by_key = {}
    for key, fp, root in rows:
        by_key.setdefault(key, set()).add((fp, root))
    return {(a[0], b[0]) for nodes in by_key.values() for a in nodes for b in nodes if a[0] < b[0] and a[1] != b[1]}


def test_keys_of_nearly_the_same_nodes_become_one(spark):
    import random

    r, rows = random.Random(3), []
    for key in range(60):  # each lacks a few nodes of one group, as its near copies differ there
        missing = set(r.sample(range(200), 12))
        rows += [(key, fp, fp) for fp in range(200) if fp not in missing]
    mixed = spark.createDataFrame(rows, "key long, fp long, root long")
    got = [tuple(x) for x in ngram_join._met_in(mixed).select("key", "fp", "root").collect()]
    assert len(got) < len(rows) / 10
    assert _met_pairs(got) == _met_pairs(rows)


def test_no_pair_is_lost_and_no_group_costs_more(spark):
    import random
    from collections import Counter

    for seed in range(3):
        r, rows = random.Random(seed), set()
        for key in range(80):
            some = r.sample(range(90), r.choice([2, 3, 5, 8, 30]))
            rows |= {(key, fp, fp % 40) for fp in some}
        rows |= {(100, fp, fp % 40) for fp in range(0, 90, 2)}
        mixed = spark.createDataFrame(sorted(rows), "key long, fp long, root long")
        got = [tuple(x) for x in ngram_join._met_in(mixed).select("key", "fp", "root").collect()]
        assert len(got) == len(set(got)) <= len(rows)
        assert _met_pairs(got) >= _met_pairs(rows)
        squares = lambda found: sum(n * n for n in Counter(key for key, _, _ in found).values())
        assert squares(got) <= squares(rows)
