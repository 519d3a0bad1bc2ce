"""Drift between consecutive windows, kept up by a stream.

Two stateful steps follow each other.  The first counts each value per
(window, model) under a watermark and emits a window once, when the watermark
has passed its end.  The second compares every closed window with the one
before it of the same model, which may be any time ago: its state is one
window's counts per model, carried from micro-batch to micro-batch in the
shared folder.  A stream-stream join would need a bound on that distance.

Windows of a model leave the first step in order of time (rows later than the
watermark are dropped), so within a batch the comparison is the batch
operator on the closed windows and the carried ones, without any per-model
loop.  Batch N reads the carried counts of batch N - 1 and replaces its own
output and its own carried counts, so a batch that runs again after a failure
gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.monitor import GRANULARITY, drift_of_counts, drift_of_values
from tidemark.plans.joins import null_safe_join
from tidemark.session import materialize
from tidemark.streaming.monitor_stream import _finish

WINDOW = ["model", "window_start"]


def windowed_counts(rows: DataFrame, ts: str, model: str, value: Column, granularity: str, watermark: str) -> DataFrame:
    """Counts per (model, window, ``v``) of a stream, each window emitted when the watermark closes it."""
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    counts = timed.groupBy(F.window("_ts", granularity).alias("w"), F.col(model).alias("model"), value.alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.select("model", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "v", "n")


def last_windows(counts: DataFrame) -> DataFrame:
    """The counts of each model's last window."""
    last = counts.groupBy("model").agg(F.max("window_start").alias("window_start"))
    return null_safe_join(counts, last, WINDOW, "left_semi")


def _categorical(counts: DataFrame, eps: float, digits: int) -> DataFrame:
    return drift_of_counts(counts.withColumnRenamed("v", "category"), None, eps, digits)


def _numeric(counts: DataFrame, digits: int) -> DataFrame:
    """Moments from the counts: the deviations are taken from the window's mean, not from sums of squares."""
    means = counts.groupBy(*WINDOW).agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"))
    centred = null_safe_join(counts, means, WINDOW).groupBy(*WINDOW).agg(
        F.first("mean").alias("mean"), F.sum("n").alias("_n"), F.sum(F.col("n") * F.pow(F.col("v") - F.col("mean"), 2)).alias("_m2"))
    stats = centred.select(*WINDOW, "mean", F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1))).alias("std"))
    return drift_of_values(materialize(stats), counts.withColumnRenamed("n", "c"), digits=digits)


def _run(spark: SparkSession, counts: DataFrame, compare: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
         timeout_s: int | None) -> DataFrame:
    root = sink.rstrip("/")
    schema = counts.schema

    def carried(batch_id: int) -> str:
        return f"{root}/carried/{batch_id % 2}"  # batch N reads the other folder, so N can run again

    def store(closed: DataFrame, batch_id: int) -> None:
        session = closed.sparkSession
        closed = materialize(closed)
        before = session.read.schema(schema).parquet(carried(batch_id - 1)) if batch_id else closed.limit(0)
        known = materialize(before.unionByName(closed))
        drift = compare(known)
        fresh = closed.select(*WINDOW).distinct()
        null_safe_join(drift, fresh, WINDOW, "left_semi").write.mode("overwrite").parquet(f"{root}/drift/batch={batch_id}")
        last_windows(known).write.mode("overwrite").parquet(carried(batch_id))

    query = (counts.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    _finish(query, timeout_s)
    return spark.read.parquet(f"{root}/drift").drop("batch")


def stream_drift_categorical(spark: SparkSession, source: DataFrame, ts: str, model: str, col: str, sink: str, checkpoint: str,
                             granularity: str = GRANULARITY, watermark: str = "1 hour", eps: float = 1e-4, digits: int = 6,
                             timeout_s: int | None = None) -> DataFrame:
    """``monitor_drift_categorical`` of all windows the watermark has closed, over every run of this stream so far.

    Null models and null categories are values of their own; a model's first window has null metrics.
    """
    counts = windowed_counts(source, ts, model, F.col(col).cast("string"), granularity, watermark)
    return _run(spark, counts, lambda c: _categorical(c, eps, digits), sink, checkpoint, timeout_s)


def stream_drift_numeric(spark: SparkSession, source: DataFrame, ts: str, model: str, col: str, sink: str, checkpoint: str,
                         granularity: str = GRANULARITY, watermark: str = "1 hour", digits: int = 6,
                         timeout_s: int | None = None) -> DataFrame:
    """``monitor_drift_numeric`` of all windows the watermark has closed, over every run of this stream so far.

    A null value is no value: a window of nulls only is no window.  A model's first window has nulls for what it is compared with.
    """
    value = F.col(col).cast("double")
    counts = windowed_counts(source.filter(value.isNotNull()), ts, model, value, granularity, watermark)
    return _run(spark, counts, lambda c: _numeric(c, digits), sink, checkpoint, timeout_s)
