"""The pipeline: each stage on what the one before kept, against what its operator says."""

from pyspark.sql import functions as F

import corpus_pipeline
from lakeretrieve.llm import mixing, quality_rules
from lakeretrieve.llm.common import stored
from lakeretrieve.llm.registry import table
from tests.llm.test_near_copies import _kept

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_DIR), "stage"))
    assert all(x.columns == docs.columns for x in seen[:-1])
    verdicts = quality_rules.judged(docs, table(spark, SF_DIR, "labels"))
    assert seen[1].count() == verdicts.where("kept").count()
    assert seen[2].count() == seen[1].count()
    long_lines = seen[2].select(F.explode(F.split("text", "\n")).alias("line")).where("length(line) >= 20")
    assert long_lines.count() == long_lines.distinct().count()
    before = [(r["doc_id"], r["text"]) for r in seen[2].collect()]
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in seen[3].collect()) == _kept(before)
    words = lambda df: df.agg(F.sum(mixing.size_of("text"))).first()[0]
    assert abs(words(seen[4]) / words(seen[3]) - 1) < 0.15
    pieces = seen[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert pieces.where("n > 2048 or n <> end").count() == 0
