"""Property tests: the bucketed / histogram helpers equal their single-node definitions."""

from __future__ import annotations

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import sampling
from tidemark.plans.ordered import exact_quantile, running_totals
from tidemark.sources import snapshots

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(0, 9)), min_size=1, max_size=60, unique_by=lambda t: t[0]),
       st.integers(1, 9), st.booleans())
def test_running_totals_equal_cumsum(spark, rows, buckets, descending):
    df = spark.createDataFrame([(float(k), c) for k, c in rows], "k double, c long")
    got = {r["k"]: r["cum_c"] for r in running_totals(df, "k", ["c"], descending=descending, buckets=buckets).collect()}
    acc = 0
    for k, c in sorted(rows, reverse=descending):
        acc += c
        assert got[float(k)] == acc


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 15)), min_size=1, max_size=80),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_equals_numpy(spark, rows, q):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    got = {r["g"]: r["quantile"] for r in exact_quantile(df, ["g"], "v", q).collect()}
    for g in {g for g, _ in rows}:
        vals = [float(v) for gg, v in rows if gg == g]
        assert math.isclose(got[g], float(np.quantile(vals, q)), abs_tol=1e-9)


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 3), max_size=20),
       st.dictionaries(st.integers(0, 30), st.integers(0, 3), max_size=20))
def test_change_feed_replays(spark, old, new):
    schema = "k int, v int"
    o = spark.createDataFrame(list(old.items()), schema)
    n = spark.createDataFrame(list(new.items()), schema)
    feed = {(r["k"], r["_change_type"]): r["v"] for r in snapshots.change_feed(o, n, ["k"]).collect()}
    state = dict(old)
    for (k, kind), v in feed.items():
        if kind in ("delete", "update_preimage"):
            assert state.pop(k) == v
    for (k, kind), v in feed.items():
        if kind in ("insert", "update_postimage"):
            state[k] = v
    assert state == new


@SETTINGS
@given(st.integers(1, 400), st.floats(0.0, 1.0))
def test_exact_split_size(spark, n, frac):
    df = spark.range(n).withColumnRenamed("id", "k")
    test = sampling.exact_split(df, ["k"], seed=5, test_fraction=frac).filter("split = 'test'").count()
    assert test == math.ceil(frac * n - 1e-9)


def test_exact_quantile_hot_group_many_buckets(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(0, 1, 6000).round(3)  # one group with thousands of distinct values
    cold = rng.integers(0, 5, 50).astype(float)
    rows = [(0, float(v)) for v in hot] + [(1, float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g int, v double")
    from tidemark.plans.ordered import exact_quantile_hist
    hist = df.groupBy("g", "v").count()
    for q, bound in ((0.1, 100), (0.5, 100), (0.97, 100), (0.5, 2_000_000)):  # 100 forces the bucketed path
        got = {r["g"]: r["quantile"] for r in
               exact_quantile_hist(hist, ["g"], "v", "count", q, buckets=7).collect()}
        assert math.isclose(got[0], float(np.quantile(hot, q)), abs_tol=1e-9)
        assert math.isclose(got[1], float(np.quantile(cold, q)), abs_tol=1e-9)
