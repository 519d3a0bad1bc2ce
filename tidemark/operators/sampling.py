"""Reproducible splits and exact-size bootstrap samples.

All randomness is an md5 uniform of ``(seed, key)``: independent of the
number of partitions or executors, identical on every rerun, and
reproducible in DuckDB for the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import hash_text, md5_uniform
from tidemark.plans.ordered import hash_bucket_totals, hash_cut, rows_at_ranks, tuple_leq


def stable_split(df: DataFrame, key_cols: Sequence[str], seed: int = 42, test_fraction: float = 0.2,
                 out_col: str = "split") -> DataFrame:
    """Row-local split: test iff md5 uniform(seed, key) < fraction.

    Old rows never move when new rows arrive; the test share is approximately
    ``test_fraction``.  Pure projection: no shuffle.
    """
    u = md5_uniform(seed, *key_cols)
    return df.withColumn(out_col, F.when(u < F.lit(float(test_fraction)), F.lit("test")).otherwise(F.lit("train")))


def exact_split(df: DataFrame, key_cols: Sequence[str], seed: int = 42, test_fraction: float = 0.2,
                 out_col: str = "split") -> DataFrame:
    """Exactly ``ceil(test_fraction * n)`` test rows: those with the smallest
    ``(md5(seed:key), key)``.  Disjoint and complete by construction.

    The cut tuple is found from two bounded hash-prefix histograms
    (``hash_cut``; n comes from the first one), so the split itself is a
    projection over the scan: no shuffle of the rows.
    """
    cut, _ = hash_cut(df, key_cols, seed, fraction=test_fraction)
    flag = F.lit(False) if cut is None else tuple_leq([hash_text(seed, *key_cols), *key_cols], list(cut))
    return df.withColumn(out_col, F.when(flag, F.lit("test")).otherwise(F.lit("train")))


def bootstrap_sample(spark: SparkSession, df: DataFrame, key_cols: Sequence[str], n: int,
                     seed: int | str = 42, draw_col: str = "draw_id") -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement.

    Draw j takes the row of rank floor(u(seed, j) * N) in the seeded hash
    order.  Only the hash buckets hit by a draw are ranked
    (``rows_at_ranks``), so sampling 1,000 rows does not shuffle the table.
    """
    totals, total = hash_bucket_totals(df, key_cols, seed)
    draws = spark.range(n).select(
        F.col("id").alias(draw_col),
        F.floor(md5_uniform(f"{seed}:draw", F.col("id")) * F.lit(total)).cast("long").alias("_idx"))
    return rows_at_ranks(df, key_cols, seed, draws, "_idx", totals, total).drop("_idx")
