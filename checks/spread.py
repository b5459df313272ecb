"""Giving every core a share of a small input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Repartition only when the input has fewer splits than the cluster has cores.

    Text rules are CPU-bound, and a small file is a single split. Large inputs have
    splits enough and are left where they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Tasks for each core, so that the last ones leave few cores idle.
TASKS_PER_CORE = 4


def share_out(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table with much work to each row, dealt by ``key`` to several tasks a core.

    Splits say little about that work: a few megabytes of keys may stand for hours, a split may
    hold no row group, and one split more than cores doubles the time. A join on ``key`` keeps
    this number, where an adaptive shuffle would count bytes.
    """
    tasks = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(tasks, df.rdd.getNumPartitions()), key)
