"""Parallelism for inputs that arrive in too few partitions.

A scan yields one task per file split; a large unsplittable file (one parquet
row group) becomes a single task, so per-row CPU work on it (JSON building
and parsing, text matching) would run on one core.  ``spread`` round-robins
such an input over the cluster's default parallelism.  It is a no-op when
the input already has enough partitions, which is the normal case on a big
table, so it never adds a shuffle there.

Catalyst pushes deterministic filters through a round-robin exchange, so a
filter whose predicate is itself expensive (a JSON parse) would still run
before the exchange; materialise the spread result when that matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
