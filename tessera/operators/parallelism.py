"""Parallelism guard for CPU-heavy per-row stages.

A scan yields one task per file split.  When a table arrives in fewer splits than the
cluster has cores (a few large row groups), an expensive per-row stage (tokenising,
splitting text, regex extraction) would run on a handful of cores.  ``spread`` adds a
round-robin repartition only in that case; on a large input with many splits it is a
no-op, so no shuffle is added at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Apply to a scan or a narrow transformation of one (as the operators here do):
    counting the splits of a frame that contains shuffles would run them.  A streaming frame is
    returned as it is: its splits are those of each micro-batch."""
    if df.isStreaming:
        return df
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() * 2 <= target:
        return df.repartition(target)
    return df
