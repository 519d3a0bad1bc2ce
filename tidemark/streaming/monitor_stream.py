"""Continuous monitor refresh with Structured Streaming.

``stream_ingest`` turns an ever-growing payload log into monitoring rows,
each request record once, by appending every micro-batch idempotently.  ``stream_window_profile`` keeps 30-minute
tumbling profiles per model; a window is written once the watermark passes
its end, and rows later than the watermark are dropped.  Both run with an
``availableNow`` trigger (process what is there, then stop) and keep their
state and offsets in a checkpoint folder, so a restarted job resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators import payload as P
from tidemark.sources.monitor_sink import DATE_COL, monitor_append


def _finish(query: StreamingQuery, timeout_s: int | None) -> None:
    """Wait for the end; only a caller that asks for a limit gets one."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()


def stream_ingest(spark: SparkSession, source_dir: str, schema: StructType | str, model_name: str, sink: str,
                  checkpoint: str, align: bool = False, max_files: int | None = None,
                  timeout_s: int | None = None) -> DataFrame:
    """Payload files -> monitoring table, every record once, whatever the order of the files.

    Each micro-batch goes through ``payload_to_monitor`` and the idempotent
    ``monitor_append``, so batch and stream refreshes store the same rows, a
    batch repeated after a failure adds nothing, and rows are never too late:
    no watermark drops them.  Records without a prediction are not stored.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def store(batch: DataFrame, _: int) -> None:
        rows = P.payload_to_monitor(batch, model_name, align, keep_all_if_no_prediction=False)
        monitor_append(batch.sparkSession, rows, sink)

    query = (reader.parquet(source_dir).writeStream.foreachBatch(store)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(query, timeout_s)
    return spark.read.parquet(sink).drop(DATE_COL)


def window_profile_stream(rows: DataFrame, ts: str, model: str, value: str, granularity: str = "30 minutes",
                          watermark: str = "1 hour", digits: int = 6) -> DataFrame:
    """Tumbling-window profile per model; emitted when the watermark closes the window."""
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    v = F.col(value).cast("double")
    agg = timed.groupBy(F.window("_ts", granularity).alias("w"), F.col(model).alias("model")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_null"),
        F.round(F.avg(v), digits).alias("mean"), F.round(F.stddev_samp(v), digits).alias("std"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      "model", "n_rows", "n_null", "mean", "std", "min_value", "max_value")


def stream_window_profile(spark: SparkSession, source: DataFrame, ts: str, model: str, value: str, sink: str,
                          checkpoint: str, granularity: str = "30 minutes", watermark: str = "1 hour",
                          timeout_s: int | None = None) -> DataFrame:
    """The profiles of all windows that the watermark has closed; windows still open at the end are not in
    the result and follow when later rows close them."""
    profile = window_profile_stream(source, ts, model, value, granularity, watermark)
    query = (profile.writeStream.format("parquet").outputMode("append").option("path", sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(query, timeout_s)
    return spark.read.parquet(sink)
