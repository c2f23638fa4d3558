"""Near copies of the pipeline against all pairs."""

import random

import corpus_pipeline
from lakeretrieve.llm import near_copies, simhash
from tests.llm.test_operators import prose


def _kept(rows, width=5):
    """The least id, null last, of each component of pairs of a Jaccard similarity of 0.8 or more."""
    words = [(t or "").split() for _, t in rows]
    sets = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a | sets[j])
            if not both or 5 * len(a & sets[j]) >= 4 * both:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((doc_id is None, doc_id))
    return sorted(min(g) for g in groups.values())


def test_keeps_one_of_each_jaccard_component(spark):
    r, rows = random.Random(5), [(None, None), (900, ""), (901, "two words"), (902, "two words")]
    phrase = prose(99, 12)
    for i in range(25):
        text = prose(i, r.randint(30, 160)).split()
        for j in range(5):
            changed = list(text)
            for _ in range(r.randint(0, 5)):
                changed[r.randrange(len(changed))] = r.choice(["x", "yy", "zzz"])
            rows.append((10 * i + j, " ".join([*changed, phrase] if i % 3 else changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x["doc_id"] is None, x["doc_id"]) for x in near_copies.keep_one(docs).collect())
    assert got == _kept(rows)
    assert len(got) < len(rows) - 25


def test_equal_ids_do_not_lose_a_component(spark):
    rows = [(1, prose(1, 60)), (1, prose(2, 60)), (2, prose(2, 60)), (None, prose(3, 60)), (None, prose(3, 60) + " x")]
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3


def test_pipeline_stage_links_by_fingerprint(spark):
    # Repeats leave the majority of every bit as it is, and the sets of shingles far apart.
    lead, tail = prose(7, 30), prose(8, 60)
    rows = [(1, " ".join([lead] * 40)), (2, " ".join([*[lead] * 40, tail])), (3, prose(9, 60)), (4, prose(9, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(near_copies.keep_one(docs).collect()) == 3
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(x["doc_id"] for x in kept) == [1, 3]
    assert sorted(x["doc_id"] for x in simhash.keep_one(docs).collect()) == [1, 3]


def test_fingerprints_keep_one_row_of_a_component(spark):
    rows = [(1, prose(1, 60)), (1, prose(2, 60)), (2, prose(2, 60)), (None, prose(3, 60)), (None, prose(3, 60))]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3


def test_kept_rows_do_not_shuffle_all_texts(spark, monkeypatch):
    from lakeretrieve.llm import common

    for bits in (1 << 24, 64):  # with 64 bits all rows are in doubt
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        numbered = common.stored(spark.range(3000).selectExpr("id as `a.key`", "concat('text ', id) as text", "id % 3 as __kept"), "rows")
        kept = common.stored(spark.range(0, 3000, 7), "kept")
        found = common.rows_kept(numbered, "a.key", kept, ["text", "__kept"])
        assert sorted(x["text"] for x in found.collect()) == sorted(f"text {i}" for i in range(0, 3000, 7))
        doubtful = found._jdf.queryExecution().analyzed().toString()
        assert "Union" in doubtful
    assert found.columns == ["text", "__kept"]


def test_texts_are_not_joined_again_by_each_step(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i // 2, 60)) for i in range(20)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(near_copies, "keep_one", lambda left, width: seen.append(left) or left)
    corpus_pipeline.near_duplicates(spark, docs, "")
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
