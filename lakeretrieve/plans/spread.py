"""More tasks for costly work on a table that is read in too few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables below a plan, from file sizes; nothing is run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def scan_splits(df: DataFrame) -> int:
    """About how many splits the tables below a plan are read in."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return input_bytes(df) // int(conf.filesMaxPartitionBytes()) + 1


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over all cores if the scan has under a quarter as many splits.

    A table worth a shuffle only for parallelism is a small one: on a large
    table the scan already has more splits than there are cores, and the rows
    stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or scan_splits(df) * 4 > cores:
        return df
    return df.repartition(cores)
