"""Streaming queries on tables that are folders of files."""

import pytest

from lakeretrieve.registry import ORACLES, QUERIES
from tests.oracle import compare, connection

SF_DIR = "/root/testdata/sf0.001"
TABLES = {
    "s01_stream_upserts": "events",
    "s02_stream_postings": "documents",
    "s02_stream_cells": "embeddings",
    "s03_stream_chat": "conversations",
}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("folders"))
    for table in TABLES.values():
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").repartition(3).write.parquet(f"{path}/{table}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(TABLES))
def test_folder_is_streamed_whole(spark, folders, name):
    assert name in ORACLES
    df = QUERIES[name](spark, folders)
    assert compare(spark, connection(SF_DIR), SF_DIR, name, df) is None
