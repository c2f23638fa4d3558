"""Quality classifier by hierarchical empirical Bayes over sites.

A logistic regression over text statistics, trained on a bounded sample of
labelled documents, gives each document a probability. A site's rate shrinks
toward the global one, and a path's rate toward its site's, the more the fewer
documents they have. How strongly is estimated from how much the sites, and the paths within
sites, differ. A document's posterior is its own evidence moved by how its
path, without the document itself, differs from all.

Rates are grouped sums, combined before the shuffle; the driver sees four
numbers. Known labels count as the evidence of their documents.

Defined cases: a null text counts as empty. A null host or path is one of its
own. Rows with equal or null ids are rated each by itself. A null label is no label; of several of an id the lowest
counts. Without labels of both kinds every document has the same evidence and is
kept. An empty table gives no rows. Columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeretrieve.llm.common import stored
from lakeretrieve.llm.quality_rules import FEATURES, ratio, with_statistics
from lakeretrieve.llm.registry import QUERIES, table

# Labelled documents that the classifier is trained on, those of smallest hash.
MOST_LABELLED = 20_000
LEAST, MOST = 1.0, 10_000.0
NEAR_ZERO = 1e-4


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - NEAR_ZERO)), F.lit(NEAR_ZERO))
    return F.log(inside / (1 - inside))


def document_evidence(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, host, path, evidence`` of ``doc_id, text, host, path``: the probability of good quality."""
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("known_id"))
        .agg(F.min("quality").cast("double").alias("label"))
    )
    counted = stored(with_statistics(docs).drop("text"), "statistics")
    features = [F.least(ratio(name).cast("double"), F.lit(20.0)).alias(name) for name in FEATURES]
    length = F.log1p("n_words").alias("log_words")
    rows = stored(
        counted.join(known, F.col("doc_id") == F.col("known_id"), "left").select("doc_id", "host", "path", "label", length, *features), "features"
    )
    chosen = rows.where("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled)
    assembler = VectorAssembler(inputCols=["log_words", *FEATURES], outputCol="features")
    training = stored(assembler.transform(chosen).select("features", "label"), "training")
    if training.select("label").distinct().count() < 2:
        return rows.select("doc_id", "host", "path", F.coalesce("label", F.lit(1.0)).alias("evidence"))
    model = LogisticRegression(maxIter=40, regParam=1e-3).fit(training)
    own = vector_to_array("probability")[1]
    scored = model.transform(assembler.transform(rows))
    return scored.select("doc_id", "host", "path", F.coalesce("label", own).alias("evidence"))


def _strength(rates: DataFrame, rate: str, center: Column, n: str) -> float:
    """How many documents a group's prior is worth, from how far rates differ beyond chance."""
    spread = F.sum(F.col(n) * (F.col(rate) - center) * (F.col(rate) - center)) / F.sum(n)
    chance = F.sum(center * (1 - center)) / F.sum(n)
    inner = F.sum(F.col(n) * center * (1 - center)) / F.sum(n)
    row = rates.agg(spread.alias("spread"), chance.alias("chance"), inner.alias("inner")).first()
    if row["spread"] is None:
        return LEAST
    between = max(row["spread"] - row["chance"], 1e-9)
    return min(max(row["inner"] / between - 1, LEAST), MOST)


def posteriors(evidence: DataFrame) -> DataFrame:
    """``evidence`` with ``host_rate``, ``path_rate`` and ``posterior``."""
    paths = stored(
        evidence.groupBy("host", "path").agg(F.sum("evidence").alias("path_sum"), F.count(F.lit(1)).alias("path_n")), "paths"
    )
    hosts = paths.groupBy(F.col("host").alias("of")).agg(F.sum("path_sum").alias("host_sum"), F.sum("path_n").alias("host_n"))
    total = hosts.agg(F.sum("host_sum"), F.sum("host_n")).first()
    overall = (total[0] or 0.0) / (total[1] or 1)
    middle = F.lit(float(overall))
    by_host = hosts.withColumn("rate", F.col("host_sum") / F.col("host_n"))
    host_weight = F.lit(_strength(by_host, "rate", middle, "host_n"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    within = both.withColumn("rate", F.col("path_sum") / F.col("path_n")).withColumn("around", F.col("host_sum") / F.col("host_n"))
    path_weight = F.lit(_strength(within, "rate", F.col("around"), "path_n"))
    sums = both.withColumnsRenamed({"host": "h", "path": "p"})
    joined = evidence.join(sums, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    host_rate = (host_weight * middle + F.col("host_sum") - F.col("evidence")) / (host_weight + F.col("host_n") - 1)
    path_rate = (path_weight * F.col("host_rate") + F.col("path_sum") - F.col("evidence")) / (path_weight + F.col("path_n") - 1)
    moved = _logit(F.col("evidence")) + _logit(F.col("path_rate")) - _logit(middle)
    return (
        joined.withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", 1 / (1 + F.exp(-moved)))
        .drop("h", "p", "path_sum", "path_n", "host_sum", "host_n")
    )


def rated(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Posteriors of ``doc_id, text, host, path`` and whether each document is kept."""
    evidence = stored(document_evidence(docs, labels), "evidence")
    return posteriors(evidence).withColumn("kept", F.col("posterior") >= least)


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source as host and their language as path."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    return rated(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "host", "path", *[F.round(c, 6).alias(c) for c in ("evidence", "host_rate", "path_rate", "posterior")], "kept"
    )


QUERIES["op6_site_quality"] = op6_site_quality
