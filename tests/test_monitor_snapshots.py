"""Monitoring, drift, snapshots, sink idempotence and batch/stream agreement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import monitor, payload as P
from tidemark.plans import standins as D
from tidemark.plans.ordered import exact_quantile
from tidemark.plans.registry import all_queries

QUERIES = all_queries()
from tidemark.session import scratch_path
from tidemark.sources import monitor_sink, snapshots


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(0)
    vals = [float(x) for x in rng.integers(0, 20, 301)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, v double")
    got = {r["g"]: (r["quantile"], r["n_distinct"]) for r in exact_quantile(df, ["g"], "v", 0.5, distinct_col="n_distinct").collect()}
    for g in range(3):
        sub = [v for i, v in enumerate(vals) if i % 3 == g]
        assert got[g][0] == np.percentile(sub, 50)
        assert got[g][1] == len(set(sub))


def test_prediction_mix_shares_sum_to_one(spark, sf_small):
    mix = monitor.monitor_prediction_mix(D.monitor_rows(spark, sf_small), "ts", "model_name", "prediction")
    sums = mix.groupBy("window_start", "model").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-12 for r in sums)


def test_drift_demo_flags_drift(spark, sf_small):
    rows = QUERIES["drift_demo"](spark, sf_small).collect()
    assert len(rows) == 1 and rows[0]["drift_flag"]
    assert rows[0]["mean_shift"] > 0 and rows[0]["total_variation"] > 0.2


def test_change_feed_replays_to_new(spark, sf_small):
    v1, v2 = D.orders_versions(spark, sf_small)
    feed = snapshots.change_feed(v1, v2, ["o_orderkey"])
    cols = v2.columns
    deleted = feed.filter(F.col("_change_type").isin("delete", "update_preimage")).select(*cols)
    added = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    replay = v1.exceptAll(deleted).unionByName(added)
    assert replay.exceptAll(v2).count() == 0 and v2.exceptAll(replay).count() == 0


def test_versions_and_latest(spark, sf_small):
    v1, v2 = D.orders_versions(spark, sf_small)
    path = scratch_path(spark, "versions_test")
    snapshots.write_version(v1, path, 1)
    snapshots.write_version(v2, path, 2)
    assert snapshots.latest_version(spark, path) == 2
    assert snapshots.read_version(spark, path, 1).exceptAll(v1).count() == 0
    snapshots.write_version(v1, path, 2)  # replacing one version leaves the other
    assert snapshots.read_version(spark, path, 1).count() == v1.count()
    assert snapshots.read_version(spark, path).count() == v1.count()


def test_monitor_append_is_idempotent(spark, sf_small):
    rows = P.payload_to_monitor(D.events_payload(spark, sf_small), D.MODEL_NAME)
    path = scratch_path(spark, "append_test")
    first = monitor_sink.monitor_append(spark, rows, path, ["databricks_request_id", "record_pos"])
    second = monitor_sink.monitor_append(spark, rows, path, ["databricks_request_id", "record_pos"])
    assert first == rows.count() and second == 0
    assert spark.read.parquet(path).count() == first


def test_stream_matches_batch_on_closed_windows(spark, sf_small):
    stream = QUERIES["stream_window_profile"](spark, sf_small)
    batch = monitor.monitor_profile(D.monitor_rows(spark, sf_small), "ts", "model_name", ["value"])
    joined = stream.join(batch.select("window_start", "model", F.col("n_rows").alias("b_n"), F.col("mean").alias("b_mean")),
                         ["window_start", "model"])
    assert joined.count() == stream.count() > 0
    assert joined.filter((F.col("n_rows") != F.col("b_n")) | (F.abs(F.col("mean") - F.col("b_mean")) > 1e-9)).count() == 0


def test_refresh_monitor_counts_and_guard(spark, sf_small):
    payload = D.events_payload(spark, sf_small)
    path = scratch_path(spark, "refresh_test")
    first = monitor_sink.refresh_monitor(spark, payload, path, D.MODEL_NAME)
    assert first["n_read"] == payload.count()
    assert first["n_appended"] == spark.read.parquet(path).count() > 0
    assert first["n_exploded"] >= first["n_appended"]
    again = monitor_sink.refresh_monitor(spark, payload, path, D.MODEL_NAME)
    assert again["n_appended"] == 0
    assert monitor_sink.refresh_monitor(spark, payload.limit(0), path, D.MODEL_NAME) is None


def test_categorical_profile_top_value(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:01:00", "m", "a"), ("2024-01-01 00:02:00", "m", "b"), ("2024-01-01 00:03:00", "m", "b"),
         ("2024-01-01 00:04:00", "m", None)], "ts string, model string, seg string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = monitor.monitor_profile_categorical(rows, "ts", "model", ["seg"]).first()
    assert (r["n_rows"], r["n_null"], r["n_distinct"], r["top_value"], r["top_count"]) == (4, 1, 2, "b", 2)
    assert abs(r["top_share"] - 2 / 3) < 1e-6


def test_monitor_quality_per_window(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:01:00", "m", 1, 1), ("2024-01-01 00:02:00", "m", 0, 1), ("2024-01-01 00:40:00", "m", 1, 1)],
        "ts string, model string, y int, p int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {str(r["window_start"]): (r["tp"], r["fp"], r["f1"]) for r in
           monitor.monitor_quality(rows, "ts", "model", "y", "p").collect()}
    assert got == {"2024-01-01 00:00:00": (1, 1, 2 / 3), "2024-01-01 00:30:00": (1, 0, 1.0)}
