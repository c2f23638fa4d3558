"""Syncmer fingerprints: matching by position, and every column against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from lakeretrieve.llm import syncmers
from tests.llm.test_operators import DOCS, LONG, ROWS, prose


def _plain_anchors(text, k, s):
    """Anchors by their definition, one k-mer after the other, over the module's hash of characters."""
    mask = 2**64 - 1

    def hashed(part):
        h = 0
        for c in part:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & mask
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        return h ^ (h >> 31)

    found = []
    for at in range(len(text) - k + 1):
        inner = [hashed(text[at + i : at + i + s]) for i in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append((at, hashed(text[at : at + k])))
    if text and not found:
        found = [(0, -1)]
    return found


def _plain_likeness(a, b):
    short = min(len(a), len(b)) < syncmers.SHORT
    sizes = (syncmers.SHORT_K, syncmers.SHORT_S) if short else (syncmers.K, syncmers.S)
    left, right = (_plain_anchors(t, *sizes) for t in (a, b))
    if [h for _, h in left] == [-1] or [h for _, h in right] == [-1]:
        return float(a == b)
    if not left and not right:
        return 1.0
    places = {}
    for at, h in right:
        places.setdefault(h, []).append(at)
    pairs = [places[h].pop(0) for _, h in left if places.get(h)]
    best = []
    for i, p in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j] < p), default=0))
    return round(2 * max(best, default=0) / (len(left) + len(right)), 6)


def test_every_column_against_plain_python(spark):
    r = random.Random(9)
    rows = [(i, prose(i % 7, r.choice([0, 1, 2, 12, 40, 60]))) for i in range(30)] + [(40, None), (41, "日本語" * 30), (42, "a" * 300), (43, "a" * 300)]
    order = sorted(rows)
    got = {x["doc_id"]: x for x in syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(got) == len(rows)
    shown = {}
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        row = got[key]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == _plain_likeness(text, edited), key
        assert row["near_next"] == _plain_likeness(text, following), key
        for content, fingerprint in ((text, row["fingerprint"]), (edited, row["edited_fingerprint"])):
            assert shown.setdefault(content, fingerprint) == fingerprint
            assert bool(fingerprint) == bool(content)


@pytest.mark.parametrize("seed", range(40))
def test_longest_run_against_pairs(seed):
    r = random.Random(seed)
    places = r.sample(range(60), r.randint(0, 30))
    if seed % 2:
        places = sorted(places[:20]) + places[20:]
    best = []
    for i, p in enumerate(places):
        best.append(1 + max((best[j] for j in range(i) if places[j] < p), default=0))
    assert syncmers.in_order(np.array(places, np.int64)) == max(best, default=0)


def test_order_of_paragraphs_counts():
    paragraphs = [prose(i, 60) for i in range(20)]
    own, turned = (syncmers.Fingerprint("\n".join(p)) for p in (paragraphs, paragraphs[::-1]))
    assert own.like(turned) < 0.2 and own.like(own) == 1


def test_single_edits_of_a_long_text_are_seen():
    r, own = random.Random(2), syncmers.Fingerprint(LONG)
    same = 0
    for _ in range(20):
        at = r.randrange(len(LONG))
        edited = syncmers.Fingerprint(LONG[:at] + "X" + LONG[at + 1 :])
        same += str(edited) == str(own)
        assert own.like(edited) > 0.999
    assert same <= 2


def test_rows_of_all_kinds(spark):
    assert len(syncmers.fingerprints(spark.createDataFrame(ROWS, DOCS)).collect()) == len(ROWS)
