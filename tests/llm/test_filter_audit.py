"""The filter audit against filters applied one after the other."""

import itertools
import re

from pyspark.sql import functions as F

from lakeretrieve.llm import filter_audit
from tests.llm.test_operators import LONG, prose

FIELDS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _failed(rows):
    """The letters that each row fails."""
    found = []
    for doc_id, text, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        earlier = doc_id is not None and any((u or "") == t and i is not None and i < doc_id for i, u, *_ in rows)
        failed = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        failed += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search("[#$%&*|]", t)) + "E" * earlier
        found.append(failed)
    return found


def _applied(rows, labels):
    failed, result, sums = _failed(rows), {}, {}
    label = lambda i, at: i is not None and any(x[0] == i and x[at] == 1 for x in labels)
    for part in {r[2] or "" for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = {i for i, r in enumerate(rows) if (r[2] or "") == part}
            gone = set()
            for step, f in enumerate(order, 1):
                out = {i for i in left if f in failed[i]}
                redundant = sum(f in failed[i] for i in gone)
                gone, left = gone | out, left - out
                alone = sum(failed[i] == f for i in left | gone)
                key = (part, "".join(order), step)
                result[key] = [len(left), len(out), redundant, alone, sum(label(rows[i][0], 1) for i in out), sum(label(rows[i][0], 2) for i in out), f]
                sums[part, f] = sums.get((part, f), 0) + len(out)
    return sorted((*key, *v[:-1], sums[key[0], v[-1]]) for key, v in result.items())


ROWS = [
    (1, prose(1, 120), "en", 1),
    (2, prose(1, 120), "en", 1),
    (2, prose(1, 120), "de", 1),
    (3, prose(1, 120), None, 1),
    (None, prose(1, 120), "en", 1),
    (None, None, "en", None),
    (4, "", "", 0),
    (5, None, "", 0),
    (6, "SHOUTED # twice twice", "en", 0),
    (7, "SHOUTED # twice twice", "en", 0),
    (8, LONG, "de", 0),
    (9, "a b " * 100, "de", 0),
    (9, "a b " * 100, "de", 0),
    (10, "a b\x0bc", "de", 0),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (7, None, 1), (9, 1, 0), (None, 1, 1)]


def test_equals_filters_applied_in_turn(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, n_chars long")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.failure_counts(docs, labels))
    assert got.columns == FIELDS
    assert sorted(map(tuple, got.collect())) == _applied(ROWS, LABELS)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, n_chars long")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    names = ["part", "id", "same", "mask", "good", "toxic", "quality", "n", "least", "__labelled", "total"]
    clashing = docs.select("*", *[F.lit("x").alias(n) for n in names])
    marked = labels.select("*", *[F.lit("x").alias(n) for n in ["good", "mask", "text", "lang"]])
    same = filter_audit.audit(filter_audit.failure_counts(clashing, marked))
    assert sorted(map(tuple, same.collect())) == _applied(ROWS, LABELS)
    assert filter_audit.audit(filter_audit.failure_counts(docs.limit(0), labels)).count() == 0
    assert sorted(map(tuple, filter_audit.audit(filter_audit.failure_counts(docs, labels.limit(0))).collect())) == _applied(ROWS, [])


def test_lattice_counts_every_order_once():
    lattice = filter_audit.Lattice("ABCD")
    assert len(lattice.edges) == 4 * 2**3
    for f in range(4):
        assert sum(w for w, (_, at) in zip(lattice.orders_through, lattice.edges) if at == f) == 24
    through = [0] * len(lattice.edges)
    for step in lattice.steps():
        through[step["path"][-1]] += 1
    assert through == lattice.orders_through
