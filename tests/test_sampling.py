"""Split and bootstrap invariants; hash ranks against a local sort."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import functions as F

from tidemark.operators import sampling
from tidemark.plans.ordered import hash_rank
from tidemark.sources.tables import table


def test_exact_split_sizes(spark, sf_small):
    cust = table(spark, sf_small, "customer")
    n = cust.count()
    for frac in (0.2, 0.4):
        out = sampling.exact_split(cust, ["c_custkey"], seed=42, test_fraction=frac)
        counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
        assert counts["test"] == math.ceil(frac * n)
        assert counts["test"] + counts["train"] == n
        assert out.select("c_custkey").distinct().count() == n


def test_exact_split_matches_local_order(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    test = {r["k"] for r in sampling.exact_split(df, ["k"], seed=7).filter("split = 'test'").collect()}
    order = sorted(range(2000), key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k))
    assert test == set(order[:400])


def test_stable_split_is_row_local(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in sampling.stable_split(df, ["k"]).collect()}
    b = {r["k"]: r["split"] for r in sampling.stable_split(df.filter("k < 500"), ["k"]).collect()}
    assert all(a[k] == b[k] for k in b)


def test_hash_rank_is_dense(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    ranks = {r["k"]: r["_rank"] for r in hash_rank(df, ["k"], 9).collect()}
    order = sorted(range(3000), key=lambda k: (hashlib.md5(f"9:{k}".encode()).hexdigest(), k))
    assert [ranks[k] for k in order] == list(range(3000))


def test_bootstrap_exact_size(spark, sf_small):
    cust = table(spark, sf_small, "customer")
    out = sampling.bootstrap_sample(spark, cust, ["c_custkey"], 777, seed=1)
    assert out.count() == 777
    assert out.select("draw_id").distinct().count() == 777
    assert out.join(cust, "c_custkey", "left_anti").count() == 0
    assert out.agg(F.countDistinct("c_custkey")).first()[0] < 777  # with replacement
