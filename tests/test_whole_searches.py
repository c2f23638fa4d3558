"""Batch searches ask with every row, whatever its id."""

import numpy as np
import pytest

from lakeretrieve.registry import ORACLES, QUERIES
from tests.oracle import compare

IDS = range(101, 161)
SEARCHES = [
    *["v12_knn_batch_cosine", "v12_knn_batch_l2", "v12_knn_batch_l1", "v12_knn_batch_tiles", "v15_threshold_batch", "v16_mmr"],
    *["v23_search_all_cells", "v23_filtered", "v23_proven", "v23_threshold", "v23_mmr"],
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Vectors with texts and labels; no id is divisible by 100."""
    duckdb = pytest.importorskip("duckdb")
    at, draw = tmp_path_factory.mktemp("whole"), np.random.default_rng(11)
    vectors = [(i, draw.normal(size=16).tolist(), 3 if i % 4 else i % 5) for i in IDS]
    texts = [(i, f"how many words {i}" if i % 2 else f"text {i}", "fr" if i % 3 else "en", f"src{i % 5}") for i in IDS]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, i % 7, 0) for i in IDS], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    con = duckdb.connect()
    for name in ("embeddings", "documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
    return str(at), con


@pytest.mark.parametrize("name", [*SEARCHES, "r01_context", "r02_answer"])
def test_every_row_asks(spark, tables, name):
    folder, con = tables
    assert "% 100" not in ORACLES[name]
    found = QUERIES[name](spark, folder)
    assert {r.qid for r in found.select("qid").collect()} == set(IDS)
    assert compare(spark, con, folder, name, found) is None


def test_every_row_asks_in_its_session(spark, tables):
    folder, con = tables
    found = QUERIES["r03_ask_in_session"](spark, folder)
    assert {r.seq for r in found.select("seq").collect()} == {2 * i + n for i in IDS for n in (0, 1)}
    assert compare(spark, con, folder, "r03_ask_in_session", found) is None


def test_recall_is_over_every_row(spark, tables):
    folder, con = tables
    assert QUERIES["v23_quantised_recall"](spark, folder).first()["neighbours"] == 10 * len(IDS)
    assert compare(spark, con, folder, "v23_quantised_recall") is None


def test_an_approximate_search_asks_with_every_row(spark, tables):
    found = QUERIES["v23_search_vector_index"](spark, tables[0])
    assert {r.qid for r in found.select("qid").collect()} == set(IDS)
