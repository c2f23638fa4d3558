"""The corpus pipeline: five stages over ``documents``, each written and read again.

Quality rules drop documents, line dedup shortens texts, SimHash and then the Jaccard similarity of
word shingles leave one document of each group, mixing repeats or drops documents toward the sources'
targets, and packing gives every piece its place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from public_tokenizers import path as vocabulary_path

from lakeretrieve.llm import near_copies, simhash
from lakeretrieve.llm.common import stored
from lakeretrieve.llm.line_dedup import dedup_lines
from lakeretrieve.llm.mixing import mix
from lakeretrieve.llm.packing import packed
from lakeretrieve.llm.quality_rules import keep_good
from lakeretrieve.llm.registry import table

# The stages train on labels and draw by position, which SQL does not express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that an earlier one has."""
    return dedup_lines(docs).drop("line_counts")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group.

    Fingerprints of five-word shingles are linked by SimHash. Of the documents it leaves, those whose
    sets have a Jaccard similarity of 0.8 or more, which differ in too many bits for it, are grouped too.
    """
    left = stored(simhash.keep_one(docs, width=5), "left")
    return near_copies.keep_one(left, width=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix with their sequences and offsets."""
    return packed(docs, vocabulary_path("byte_bpe_50k.json"), 0)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
