"""Histogram boosting against a plain walk over its trees, and its edge cases."""

from __future__ import annotations

import math
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting as B

SCHEMA = "id long, cat string, num double, y int"
FEW = B.Settings(trees=3, depth=3, rate=0.3, min_rows=5)


def rows(n=600):
    out = []
    for i in range(n):
        cat = None if i % 13 == 0 else "abcde"[i * 7 % 5]
        num = None if i % 9 == 0 else float(i * 31 % 101)
        out.append((i, cat, num, int((cat in ("a", "d")) != (num is None or num > 60))))
    return out


def plain_margin(model, code, num):
    """Walks one row through all trees; ``code`` is -1 for missing or unseen."""
    edges = model.edges["num"]
    missing = num is None or math.isnan(num)
    bins = [code + 1, 0 if missing else max(1, sum(e <= num for e in edges))]
    total = model.start
    for t in model.trees:
        node = 0
        while t.feature[node] >= 0:
            f = t.feature[node]
            node = 2 * node + (1 if t.left[node, bins[f]] else 2)
        total += t.value[node]
    return total


@pytest.fixture(scope="module")
def model(spark):
    return B.train(spark.createDataFrame(rows(), SCHEMA), ["cat"], ["num"], "y", FEW)


def test_scores_equal_a_plain_walk_on_known_unseen_and_missing_values(spark, model):
    codes = {r.category: r.code for r in model.codes.collect()}
    probe = [(1, "a", 5.0, None), (2, "new", 70.0, None), (3, None, None, None), (4, "e", -1e9, None), (5, "c", 1e9, None), (6, "d", float("nan"), None), (7, "b", 60.0, None)]
    got = {r.id: (r.margin, r.probability) for r in model.scored(spark.createDataFrame(probe, SCHEMA)).collect()}
    for i, cat, num, _ in probe:
        want = plain_margin(model, codes.get(cat, -1), num)
        assert got[i][0] == pytest.approx(want, abs=1e-12)
        assert got[i][1] == pytest.approx(1 / (1 + math.exp(-want)), abs=1e-12)


def test_learns_sets_of_categories_and_the_side_of_missing_values(spark):
    deep = B.train(spark.createDataFrame(rows(), SCHEMA), ["cat"], ["num"], "y", B.Settings(trees=6, depth=3, rate=1.0, min_rows=5))
    wrong = deep.scored(spark.createDataFrame(rows(), SCHEMA)).where(F.col("prediction") != F.col("y")).count()
    assert wrong == 0  # neither an order of codes nor an imputed number separates these


def test_order_and_partitions_change_nothing(spark, model):
    again = B.train(spark.createDataFrame(rows()[::-1], SCHEMA).repartition(7), ["cat"], ["num"], "y", FEW)
    assert again.table(spark).collect() == model.table(spark).collect()


def test_siblings_add_up_to_their_parent(model):
    for t in model.trees:
        for k in range(2**FEW.depth - 1):
            if t.feature[k] >= 0:
                assert t.rows[k] == t.rows[2 * k + 1] + t.rows[2 * k + 2] and t.gain[k] > 0


def test_save_and_load_score_the_same(spark, model, tmp_path):
    model.save(str(tmp_path / "m"))
    later = B.BoostedModel.load(spark, str(tmp_path / "m"))
    df = spark.createDataFrame(rows(60), SCHEMA)
    assert model.scored(df).orderBy("id").collect() == later.scored(df).orderBy("id").collect()


def test_deep_trees_keep_a_small_plan(spark):
    began = time.time()
    deep = B.train(spark.createDataFrame(rows(), SCHEMA), ["cat"], ["num"], "y", B.Settings(trees=1, depth=6, rate=0.1, min_rows=2))
    assert len(deep.trees) == 1 and deep.trees[0].rows[0] == 600 and time.time() - began < 120


@pytest.mark.parametrize("data", [[], [(1, "a", 1.0, None)], [(1, "a", 1.0, 1), (2, None, None, 1)]])
def test_no_rows_no_labels_or_one_class_is_a_constant(spark, data):
    flat = B.train(spark.createDataFrame(data, SCHEMA), ["cat"], ["num"], "y", FEW)
    assert not flat.trees
    p = {r.probability for r in flat.scored(spark.createDataFrame(rows(5), SCHEMA)).collect()}
    assert len(p) == 1 and (p.pop() > 0.99) == any(r[3] == 1 for r in data)


def test_columns_without_any_value(spark):
    empty = [(i, None, None, i % 2) for i in range(80)]
    assert not B.train(spark.createDataFrame(empty, SCHEMA), ["cat"], ["num"], "y", FEW).trees
