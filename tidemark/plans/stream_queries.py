"""Registered Structured Streaming queries (file source, availableNow trigger)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import standins as D
from tidemark.plans.queries import query
from tidemark.session import scratch_path
from tidemark.streaming import drift_stream as W
from tidemark.streaming import monitor_stream as T

WATERMARK = "1 hour"


@query
def stream_ingest(spark, sf_dir):
    """The events payload log written as files (a quarter of it twice, as a retried
    delivery would), streamed into monitoring rows with each record once."""
    log = scratch_path(spark, "payload_log")
    payload = D.events_payload(spark, sf_dir)
    payload.write.mode("append").parquet(log)
    payload.filter(F.col("request_time") < F.lit("2024-01-08").cast("timestamp_ntz")).write.mode(
        "append").parquet(log)
    out = T.stream_ingest(spark, log, payload.schema, D.MODEL_NAME, scratch_path(spark, "monitor_sink"),
                          scratch_path(spark, "ingest_ckpt"))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query
def stream_window_profile(spark, sf_dir):
    """30-minute profiles of event values per model; only windows the watermark closed."""
    events_dir = sf_dir.rstrip("/")
    src = spark.readStream.schema(spark.read.parquet(f"{events_dir}/events.parquet").schema).option(
        "pathGlobFilter", "events.parquet").parquet(events_dir)
    rows = src.select("ts", F.col("event_type").alias("model_name"), "value")
    return T.stream_window_profile(spark, rows, "ts", "model_name", "value", scratch_path(spark, "profile_sink"),
                                   scratch_path(spark, "profile_ckpt"), watermark=WATERMARK)


def _delivered(spark, sf_dir, step):
    """Calls ``step(source)`` after each of four deliveries of the events: rows arrive up to an hour after their
    time, so files overlap in time and rows inside them are out of order.  Each call is a restarted stream."""
    rows = D.monitor_rows(spark, sf_dir).withColumn("_arrival", F.col("ts") + F.expr("make_dt_interval(0, 0, 20 * (user_id % 4))"))
    log = scratch_path(spark, "monitor_log")
    bounds = [None, "2024-01-08 10:10:00", "2024-01-15 00:00:00", "2024-01-23 17:45:00", None]
    for low, high in zip(bounds, bounds[1:]):
        part = rows
        if low:
            part = part.filter(F.col("_arrival") >= F.lit(low).cast("timestamp_ntz"))
        if high:
            part = part.filter(F.col("_arrival") < F.lit(high).cast("timestamp_ntz"))
        part.drop("_arrival").write.mode("append").parquet(log)
        out = step(spark.readStream.schema(rows.drop("_arrival").schema).parquet(log))
    return out


@query
def stream_drift_categorical(spark, sf_dir):
    """Drift of segments between consecutive closed windows, kept by a stream over four deliveries."""
    folders = scratch_path(spark, "drift"), scratch_path(spark, "drift_ckpt")
    return _delivered(spark, sf_dir, lambda source: W.stream_drift_categorical(
        spark, source, "ts", "model_name", "segment", *folders, watermark=WATERMARK))


@query
def stream_drift_numeric(spark, sf_dir):
    """Drift of values between consecutive closed windows, kept by a stream over four deliveries."""
    folders = scratch_path(spark, "drift"), scratch_path(spark, "drift_ckpt")
    return _delivered(spark, sf_dir, lambda source: W.stream_drift_numeric(
        spark, source, "ts", "model_name", "value", *folders, watermark=WATERMARK))
