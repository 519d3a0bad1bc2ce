"""Rows that ordinary tables lack: null models and ids, repeated and late requests, wrong fields, many categories."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.functions import schemas as S
from tidemark.operators import features, monitor, payload, runs, sampling, synth
from tidemark.plans import joins, ordered
from tidemark.session import scratch_path
from tidemark.sources import monitor_sink, snapshots, tables
from tidemark.streaming import monitor_stream

LOG = "request string, response string, request_time timestamp, databricks_request_id string, execution_duration_ms long"


def record(**change):
    values = {n: (1.5 if t == "double" else "x") for n, t in S.FEATURE_FIELDS} | change
    return {k: v for k, v in values.items() if v is not ...}


def request(*records):
    import json

    return json.dumps({S.RECORDS_FIELD: list(records)})


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def three_requests():
    day = dt.datetime(2024, 5, 3, 12)
    answer = '{"predictions":[1,0]}'
    two = request(record(), record(Height=2.5))
    return [(two, answer, day, "r1", 1), (two, answer, day, "r1", 1), (request(record()), answer, None, "r2", 1), (request(record(Weight=9.0)), answer, None, None, 1)]


def test_append_stores_each_request_once(spark):
    rows = payload.payload_to_monitor(log(spark, three_requests()), "m", align=True)
    path = scratch_path(spark, "append")
    assert [monitor_sink.monitor_append(spark, rows, path) for _ in range(3)] == [4, 0, 0]
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and sorted(r[0] for r in stored.where("databricks_request_id = 'r1'").select("prediction").collect()) == [0, 1]
    more = payload.payload_to_monitor(log(spark, [(request(record(Weight=8.0)), '{"predictions":[1]}', None, None, 1)]), "m")
    assert monitor_sink.monitor_append(spark, more, path) == 1  # another unnamed request


def test_append_by_table_name(spark):
    rows = payload.payload_to_monitor(log(spark, three_requests()), "m")
    spark.sql("DROP TABLE IF EXISTS monitor_by_name")
    assert [monitor_sink.monitor_append(spark, rows, "monitor_by_name") for _ in range(2)] == [4, 0]
    snapshots.snapshot_overwrite(rows.select("record_pos"), "snapshot_by_name")
    assert tables.read_target(spark, "snapshot_by_name").count() == rows.count()
    spark.sql("DROP TABLE monitor_by_name")
    spark.sql("DROP TABLE snapshot_by_name")


@pytest.mark.parametrize("align", [False, True])
def test_stream_equals_batch_whatever_the_order(spark, align):
    source = scratch_path(spark, "late_log")
    rows = []
    for k in (5, 1, 4, 0, 3, 2):  # one file per day, days out of order
        rows += [(request(record(), record()), f'{{"predictions":[{k % 2},1]}}', dt.datetime(2024, 5, 1 + k), f"q{k}", k)]
        log(spark, rows[-1:]).coalesce(1).write.mode("append").parquet(source)
    log(spark, rows[:2]).coalesce(1).write.mode("append").parquet(source)  # delivered again
    got = monitor_stream.stream_ingest(spark, source, LOG, "m", scratch_path(spark, "late_sink"), scratch_path(spark, "late_ckpt"), align=align, max_files=1)
    want = payload.payload_to_monitor(log(spark, rows), "m", align=align)
    columns = ["databricks_request_id", "record_pos", "prediction", "Height"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert got.count() == 12


def monitored(spark):
    start = dt.datetime(2024, 5, 1)
    rows = [(start + dt.timedelta(minutes=7 * k), None if k % 3 == 0 else "a", float(k % 5), f"c{k % 2}") for k in range(60)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, model string, v double, c string")


def test_null_models_are_a_model(spark):
    rows = monitored(spark)
    named = rows.withColumn("model", F.coalesce("model", F.lit("none")))
    for fn, col in ((monitor.monitor_drift_numeric, "v"), (monitor.monitor_drift_categorical, "c")):
        assert sorted(map(str, map(tuple, fn(rows, "ts", "model", col).withColumn("model", F.coalesce("model", F.lit("none"))).collect()))) == sorted(map(str, map(tuple, fn(named, "ts", "model", col).collect())))
    profile = monitor.monitor_profile(rows, "ts", "model", ["v"])
    assert profile.where("model IS NULL").count() > 0
    assert sorted(map(str, map(tuple, profile.withColumn("model", F.coalesce("model", F.lit("none"))).collect()))) == sorted(map(str, map(tuple, monitor.monitor_profile(named, "ts", "model", ["v"]).collect())))


def test_drift_against_a_baseline(spark):
    rows = monitored(spark)
    same = monitor.monitor_drift_numeric(rows, "ts", "model", "v", granularity="30 days", baseline=rows).collect()
    assert len(same) == 2 and all(r["ks"] == 0 and r["mean_shift"] == 0 and r["prev_start"] is None for r in same)
    other = monitor.monitor_drift_categorical(rows, "ts", "model", "c", granularity="30 days", baseline=rows.withColumn("c", F.lit("new"))).collect()
    assert all(math.isclose(r["total_variation"], 1.0) for r in other)
    only_a = monitor.monitor_drift_categorical(rows, "ts", "model", "c", granularity="30 days", baseline=rows.where("model = 'a'")).collect()
    assert {r["model"]: r["psi"] for r in only_a} == {"a": 0.0, None: None}


def test_ordered_groups_in_any_number_of_buckets(spark):
    rows = [(None if k % 2 else "g", float(k), k) for k in range(40)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    one = sorted(map(str, map(tuple, ordered.grouped_running_totals(df, ["g"], "v", ["n"], buckets=1).collect())))
    assert len(one) == 40
    assert sorted(map(str, map(tuple, ordered.grouped_running_totals(df, ["g"], "v", ["n"], buckets=9).collect()))) == one


def test_range_ranks(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.format_string("%04d", F.col("id") * 7 % 500).alias("c"))
    got = {(r["g"], r["c"]): r["place"] for r in ordered.range_ranks(df, "g", "c", "place").collect()}
    for g in range(3):
        mine = sorted(c for k, c in got if k == g)
        assert [got[g, c] for c in mine] == list(range(len(mine)))
    codes = features.fit_category_codes(df.select(F.col("g").cast("string").alias("g")), ["g"])
    assert sorted((r["category"], r["code"]) for r in codes.collect()) == [("0", 0), ("1", 1), ("2", 2)]


def test_null_keys_in_splits_and_hashes(spark):
    df = spark.createDataFrame([(None, str(k)) for k in range(100)], "a string, b string")
    assert sampling.exact_split(df, ["a", "b"], test_fraction=0.2).where("split = 'test'").count() == 20
    pair = spark.createDataFrame([("a", None), (None, "a")], "x string, y string").select(exprs.hash_text(1, "x", "y").alias("h"))
    assert pair.distinct().count() == 2


def test_draws_reach_beyond_32_bits(spark):
    u = spark.range(2000).select((exprs.md5_uniform(1, "id") * F.lit(2.0**52)).cast("long").alias("u"))
    assert u.where(F.col("u") % (1 << 20) != 0).count() > 1900  # 32-bit draws would all be multiples


def test_shares_of_many_categories(spark):
    source = spark.range(3000).select(F.when(F.col("id") % 10 != 0, F.format_string("c%05d", F.col("id") % 700)).alias("c"))
    rows = synth.share_table(source, "c").collect()
    rows = sorted(rows, key=lambda r: r["lo"])
    assert rows[0]["category"] is None and math.isclose(rows[0]["hi"], 0.1) and rows[-1]["hi"] == 1.0
    assert all(a["hi"] == b["lo"] and (a["category"] or "") < b["category"] for a, b in zip(rows, rows[1:]))


def test_joins_are_measured_and_null_safe(spark):
    long_text = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.bounded(long_text) and not joins.bounded(long_text, max_bytes=2000) and not joins.bounded(long_text, max_rows=2)
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (4, "z")], "k int, r string")
    full = joins.null_safe_join(left, right, ["k"], "full_outer")
    assert sorted(map(str, map(tuple, full.collect()))) == sorted(map(str, [(1, "a", "x"), (None, "b", "y"), (3, "c", None), (4, None, "z")]))
    assert joins.null_safe_join(left, right, ["k"], "left_anti").collect()[0]["l"] == "c"


def test_quarantine_names_missing_unknown_and_wrong_fields(spark):
    bad = [record(Height=...), record(Extra=1), record(Weight="heavy"), record(Gender=None), record()]
    rows = payload.quarantine(log(spark, [(request(*bad), "", None, "q", 1), ("{}", "", None, "e", 1)]))
    got = {(r["databricks_request_id"], r["record_pos"]): r["reason"] for r in rows.collect()}
    assert got == {("q", 0): "missing:Height", ("q", 1): "unknown:Extra", ("q", 2): "bad_type:Weight", ("q", 3): None, ("q", 4): None, ("e", None): "unparsable_request"}


def test_requests_hold_no_nan(spark):
    df = spark.createDataFrame([tuple(float("nan") if t == "double" else "x" for _, t in S.FEATURE_FIELDS)], ", ".join(f"{n} {t}" for n, t in S.FEATURE_FIELDS))
    assert '"Height":null' in df.select(payload.build_request().alias("r")).first()["r"]


def test_run_search_conditions(spark):
    table = spark.createDataFrame([(1, "FINISHED", 1, {"t": "x"}, {"depth": "3"}), (2, "FINISHED", 2, {}, {"depth": "4"}), (3, "FAILED", 3, {"t": "y"}, {})], "run_id int, status string, start_time int, tags map<string,string>, params map<string,string>")
    metrics = spark.createDataFrame([(1, "f1", 0.5, 0), (1, "f1", 0.9, 1), (2, "f1", 0.7, 0), (2, "loss", 0.1, 0), (3, "f1", 0.8, 0)], "run_id int, key string, value double, step int")
    find = lambda **k: [r["run_id"] for r in runs.run_search(table, metrics, **k).collect()]
    assert find(metric_conditions=[("f1", ">", 0.6)]) == [3, 2, 1]
    assert find(metric_conditions=[("f1", ">", 0.6), ("loss", "<=", 0.1)]) == [2]
    assert find(tag_conditions=[("t", "!=", "y")], order_by=["start_time"]) == [1, 2]
    assert find(param_conditions=[("depth", "=", "3")], status="FINISHED") == [1]


def test_metric_ties_go_to_the_latest(spark):
    df = spark.createDataFrame([(1, "m", 0.9, 5, 10), (1, "m", 0.2, 5, 11)], "run_id int, key string, value double, step int, ts int")
    assert runs.metric_steps(df, time_col="ts").first()["value"] == 0.2 and runs.metric_steps(df).first()["value"] == 0.9


def test_several_granularities_and_share_tables_from_one_scan(spark):
    rows = monitored(spark)
    both = monitor.at_granularities(monitor.monitor_profile, rows, "ts", "model", ["v"], ["1 hour", "2 hours"])
    for g in ("1 hour", "2 hours"):
        one = monitor.monitor_profile(rows, "ts", "model", ["v"], granularity=g)
        assert sorted(map(str, map(tuple, both.where(F.col("granularity") == g).select(*one.columns).collect()))) == sorted(map(str, map(tuple, one.collect())))
    counted = synth.category_counts(rows, ["c", "model"])
    for c in ("c", "model"):
        assert sorted(map(str, synth.share_table(rows, c, counted).collect())) == sorted(map(str, synth.share_table(rows, c).collect()))
