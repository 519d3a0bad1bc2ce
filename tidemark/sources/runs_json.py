"""Experiment-tracking exports as tables: run records and logged-model metric lists.

Both are JSON documents read with a declared schema (never inferred); maps
and arrays stay columnar and are unnested with ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names of the tracking server's run and logged-model exports.
RUN_SCHEMA = (
    "info struct<run_id: string, run_name: string, experiment_id: string, status: string, start_time: long, "
    "end_time: long, lifecycle_stage: string, user_id: string, artifact_uri: string>, "
    "data struct<metrics: map<string, double>, params: map<string, string>, tags: map<string, string>>"
)
LOGGED_MODEL_SCHEMA = (
    "model_id string, experiment_id string, creation_timestamp long, last_updated_timestamp long, "
    "metrics array<struct<_key: string, _value: double, _timestamp: long, _step: long, _model_id: string, "
    "_dataset_name: string, _dataset_digest: string, _run_id: string>>"
)


def read_runs(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One row per run: ids, status, start/end as timestamps, and the three maps."""
    raw = spark.read.schema(RUN_SCHEMA).option("multiLine", multiline).json(path)
    return raw.select(
        F.col("info.run_id").alias("run_id"), F.col("info.run_name").alias("run_name"),
        F.col("info.experiment_id").alias("experiment_id"), F.col("info.status").alias("status"),
        F.timestamp_millis("info.start_time").alias("start_time"), F.timestamp_millis("info.end_time").alias("end_time"),
        F.col("data.metrics").alias("metrics"), F.col("data.params").alias("params"), F.col("data.tags").alias("tags"))


def write_runs(runs: DataFrame, path: str) -> None:
    """Runs table -> JSON lines in the export's nested shape (``info`` / ``data``)."""
    info = F.struct(F.col("run_id").cast("string").alias("run_id"), F.col("run_name"),
                    F.col("status"), F.unix_millis(F.col("start_time").cast("timestamp")).alias("start_time"))
    data = F.struct(F.col("metrics"), F.col("tags"))
    runs.select(info.alias("info"), data.alias("data")).write.mode("overwrite").json(path)


def read_logged_model_metrics(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Metric entries of logged models as EAV rows (key, value, timestamp, step, model, dataset, run)."""
    raw = spark.read.schema(LOGGED_MODEL_SCHEMA).option("multiLine", multiline).json(path)
    m = raw.select(F.explode("metrics").alias("m"))
    return m.select(F.col("m._key").alias("key"), F.col("m._value").alias("value"),
                    F.timestamp_millis("m._timestamp").alias("timestamp"), F.col("m._step").alias("step"),
                    F.col("m._model_id").alias("model_id"), F.col("m._dataset_name").alias("dataset_name"),
                    F.col("m._dataset_digest").alias("dataset_digest"), F.col("m._run_id").alias("run_id"))
