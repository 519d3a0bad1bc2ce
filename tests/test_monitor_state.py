"""Refreshing profiles from states, and drift kept by a stream, against the operators that read everything."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor
from tidemark.session import local_path, scratch_path
from tidemark.sources import monitor_state as M
from tidemark.streaming import drift_stream as W

ROWS = "ts string, model string, seg string, x double"


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROWS).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _same(a, b, digits=6):
    cols = sorted(b.columns)
    shown = lambda df: sorted(str([round(v, digits) if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())
    assert sorted(a.columns) == cols and shown(a) == shown(b)


DAY_ONE = [("2024-01-01 00:01:00", "m", "a", 1.0), ("2024-01-01 00:02:00", "m", "b", None), ("2024-01-01 00:03:00", None, "a", 4.0),
           ("2024-01-01 00:31:00", "m", None, None), (None, "m", "a", 9.0)]
DAY_TWO = [("2024-01-02 10:00:00", "m", "a", 2.0), ("2024-01-02 10:00:00", "m", "a", 2.0)]
LATE = [("2024-01-01 00:04:00", "m", "a", 1e9), ("2024-01-01 00:32:00", "m", "c", 7.5), ("2024-01-01 05:00:00", "n", "c", -1.0)]


def test_late_rows_and_a_repeated_batch_equal_a_full_run(spark):
    path = scratch_path(spark, "state_test")
    for batch, rows in ((0, DAY_ONE), (1, DAY_TWO), (2, LATE), (2, LATE)):
        got = M.refresh_profile(spark, _rows(spark, rows), "ts", "model", ["x"], path, batch)
    _same(got, monitor.monitor_profile(_rows(spark, DAY_ONE + DAY_TWO + LATE), "ts", "model", ["x"]))
    _same(M.refresh_profile(spark, _rows(spark, []), "ts", "model", ["x"], path, 3), got)


def test_refresh_reads_touched_dates_only(spark):
    path = scratch_path(spark, "state_pruned")
    third = [(f"2024-01-03 0{h}:00:00", "m", "a", float(h)) for h in range(3)]
    for batch, rows in ((0, DAY_ONE + DAY_TWO + third),):
        M.refresh_profile(spark, _rows(spark, rows), "ts", "model", ["x"], path, batch)
    before = {r["window_start"]: r for r in M.stored_profile(spark, path).collect() if r["model"] == "m"}
    # A file that no reader can open, on a date between the two that the next batch touches.
    for part in ("moments", "values"):
        with open(os.path.join(local_path(path), part, "date=2024-01-02", "batch=0", "part-broken.parquet"), "w") as f:
            f.write("not parquet")
    M.refresh_profile(spark, _rows(spark, LATE + third), "ts", "model", ["x"], path, 1)
    after = {r["window_start"]: r for r in M.stored_profile(spark, path).collect() if r["model"] == "m"}
    changed = {str(w) for w in after if after[w] != before.get(w)}
    assert changed == {"2024-01-01 00:00:00", "2024-01-01 00:30:00"} | {f"2024-01-03 0{h}:00:00" for h in range(3)}


@pytest.mark.parametrize("seed", [1, 2])
def test_moments_merge_in_any_split(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, 1e-2, 400)  # a large mean and a small spread, where sums of squares lose all digits
    cut = np.sort(rng.integers(0, 400, 5))
    parts = [p for p in np.split(x, cut) if len(p)]
    rows = [("k", len(p) + 1, 1, float(p.mean()), float(((p - p.mean()) ** 2).sum()), float(p.min()), float(p.max())) for p in parts]
    rows.append(("k", 3, 3, None, None, None, None))  # nulls only
    df = spark.createDataFrame(rows, "k string, n_rows long, n_null long, mean double, m2 double, min_value double, max_value double")
    got = M.merge_moments(df, ["k"]).first()
    assert (got["n_rows"], got["n_null"]) == (400 + len(parts) + 3, len(parts) + 3)
    assert got["mean"] == pytest.approx(x.mean(), rel=1e-14) and got["std"] == pytest.approx(x.std(ddof=1), rel=1e-6)
    assert (got["min_value"], got["max_value"]) == (x.min(), x.max())


SCHEMA = "ts timestamp_ntz, model string, seg string, x double"
# Windows of ``m`` with a gap of a day, of a null model, and of a model that comes late; rows out of order inside and between files.
FILE_ONE = [("2024-01-01 00:40:00", "m", "b", 3.0), ("2024-01-01 00:05:00", "m", "a", 1.0), ("2024-01-01 00:10:00", None, "a", 2.0),
            ("2024-01-01 00:20:00", "m", None, None), ("2024-01-01 01:05:00", "m", "b", 5.0)]
FILE_TWO = [("2024-01-01 00:15:00", "m", "a", 1.5), ("2024-01-02 03:00:00", "m", "a", 4.0), ("2024-01-02 03:01:00", None, "b", 2.5)]
TOO_LATE = [("2024-01-01 00:06:00", "m", "zzz", 99.0)]
FILE_THREE = TOO_LATE + [("2024-01-02 03:10:00", "m", "c", 8.0), ("2024-01-03 00:00:00", "q", "a", 1.0)]


@pytest.mark.parametrize("kind", ["categorical", "numeric"])
def test_stream_drift_equals_batch_drift_of_closed_windows(spark, kind):
    log, sink, ckpt = (scratch_path(spark, n) for n in ("log", "drift", "ckpt"))
    stream, batch, col = ((W.stream_drift_categorical, monitor.monitor_drift_categorical, "seg") if kind == "categorical"
                          else (W.stream_drift_numeric, monitor.monitor_drift_numeric, "x"))
    sizes = []
    for rows in (FILE_ONE, FILE_TWO, FILE_THREE):  # a restarted stream after every delivery
        _rows(spark, rows).coalesce(1).write.mode("append").parquet(log)
        got = stream(spark, spark.readStream.schema(SCHEMA).parquet(log), "ts", "model", col, sink, ckpt)
        sizes.append(got.count())
    kept = _rows(spark, FILE_ONE + FILE_TWO + [r for r in FILE_THREE if r not in TOO_LATE])
    full = batch(kept, "ts", "model", col).filter(F.col("window_start") <= F.lit("2024-01-02 22:30:00").cast("timestamp_ntz"))
    _same(got, full)
    assert sizes[0] < sizes[1] < sizes[2] == full.count()
    again = stream(spark, spark.readStream.schema(SCHEMA).parquet(log), "ts", "model", col, sink, ckpt)  # nothing new
    _same(again, full)
