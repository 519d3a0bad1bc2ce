"""Checked broadcast fallback, train/test tables with load time, run inputs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.operators import clean, runs, sampling
from tidemark.plans import standins as D
from tidemark.plans.joins import bounded, lookup_join
from tidemark.session import scratch_path
from tidemark.sources import snapshots


def test_lookup_join_same_result_above_bound(spark):
    big = spark.range(200).withColumn("k", F.col("id") % 7)
    small = spark.range(5).withColumnRenamed("id", "k").withColumn("tag", F.lit("x"))
    broadcasted = lookup_join(big, small, "k", "left", max_rows=100)
    shuffled = lookup_join(big, small, "k", "left", max_rows=2)  # over the bound: no broadcast hint
    assert bounded(small, 5) and not bounded(small, 4)
    assert sorted(map(tuple, broadcasted.collect())) == sorted(map(tuple, shuffled.collect()))


def test_rare_to_other_over_bound_matches(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select(
        "doc_id", F.concat("source", F.lit("_"), "lang").alias("category"))
    a = {r["doc_id"]: r["category"] for r in clean.rare_to_other(docs, "category", 3).collect()}
    b = {r["doc_id"]: r["category"] for r in clean.rare_to_other(docs, "category", 3, max_broadcast_rows=1).collect()}
    assert a == b


def test_save_train_test_with_load_time(spark, sf_small):
    cleaned = clean.clean_table(D.raw_characters(spark, sf_small))
    split = sampling.exact_split(cleaned, ["Id"], seed=42, test_fraction=0.2)
    train_p, test_p = snapshots.save_train_test(split, scratch_path(spark, "tt"), load_time="2024-03-01 00:00:00")
    train, test = spark.read.parquet(train_p), spark.read.parquet(test_p)
    n = cleaned.count()
    assert test.count() == math.ceil(0.2 * n) and train.count() + test.count() == n
    assert train.join(test, "Id").count() == 0
    assert {r[0] for r in test.select(F.col("update_timestamp_utc").cast("string")).distinct().collect()} == {
        "2024-03-01 00:00:00"}


def test_input_dataset(spark):
    inputs = spark.createDataFrame([(1, "training", "t1"), (1, "testing", "t2"), (2, "training", "t3")],
                                   "run_id int, context string, table string")
    assert [r["table"] for r in runs.input_dataset(inputs, 1, "testing").collect()] == ["t2"]


def test_logged_model_metrics_roundtrip(spark):
    import json

    from tidemark.operators.metrics import rates
    from tidemark.sources import runs_json
    published = {"true_negatives": 378, "false_positives": 4184, "false_negatives": 166, "true_positives": 13784}
    doc = {"model_id": "m-1", "experiment_id": "e", "creation_timestamp": 1, "last_updated_timestamp": 2,
           "metrics": [{"_key": k, "_value": float(v), "_timestamp": 3, "_step": 0, "_model_id": "m-1",
                        "_dataset_name": "dataset", "_dataset_digest": "d", "_run_id": "r"} for k, v in published.items()]}
    path = scratch_path(spark, "logged_model")
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(path)
    rows = runs_json.read_logged_model_metrics(spark, path, multiline=False)
    wide = rows.groupBy().pivot("key", list(published)).agg(F.first("value"))
    cm = wide.select(*[F.col(k).cast("long").alias(a) for k, a in
                       (("true_positives", "tp"), ("false_positives", "fp"), ("true_negatives", "tn"), ("false_negatives", "fn"))])
    assert rates(cm).first()["f1"] == 0.8637132652421831


def test_spread_is_noop_on_partitioned_input(spark):
    from tidemark.plans.partitioning import spread
    wide = spark.range(0, 1000, numPartitions=8)
    assert spread(wide, 8) is wide  # enough partitions: no exchange added
    narrow = spark.range(0, 1000, numPartitions=1)
    spread_df = spread(narrow, 8)
    assert spread_df.rdd.getNumPartitions() == 8
    assert sorted(r.id for r in spread_df.collect()) == list(range(1000))
