"""Metric formulas against the published numbers and brute force."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import metrics as M
from tidemark.plans.ordered import running_totals


def test_published_confusion_matrix(spark):
    cm = spark.createDataFrame([(13784, 4184, 378, 166)], "tp long, fp long, tn long, fn long")
    r = M.rates(cm).first()
    assert r["accuracy"] == 0.7650172860847018
    assert r["precision"] == 0.7671415850400712
    assert r["recall"] == 0.9881003584229391
    assert r["f1"] == 0.8637132652421831


def _brute(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, tp_prev = 0.0, 0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        ap += (tp - tp_prev) / len(pos) * tp / (tp + fp)
        tp_prev = tp
    return auc, ap


@pytest.mark.parametrize("seed", [1, 2])
def test_curves_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]  # many ties
    df = spark.createDataFrame(rows, "y int, s double")
    got = M.curve_areas(df, "y", "s", buckets=7).first()
    auc, ap = _brute(rows)
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(ap, abs=1e-12)


def test_running_totals_many_buckets(spark):
    rnd = random.Random(3)
    rows = [(float(i), rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k double, c long")
    got = {r["k"]: r["cum_c"] for r in running_totals(df, "k", ["c"], buckets=13).collect()}
    acc = 0
    for k, c in rows:
        acc += c
        assert got[k] == acc


def test_log_loss_and_evaluate(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.2, 0), (1, 0.4, 0), (0, 0.6, 1)], "y int, p double, pred int")
    import math
    expected = -(math.log(0.9) + math.log(0.8) + math.log(0.4) + math.log(0.4)) / 4
    assert M.log_loss(df, "y", "p").first()[0] == pytest.approx(expected)
    ev = {r["metric"]: r["value"] for r in M.evaluate(df, "y", "pred", "p").collect()}
    assert ev["tp"] == 1 and ev["fp"] == 1 and ev["accuracy"] == 0.5 and ev["roc_auc"] == 0.75


def test_champion_challenger_ties_promote(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 0, 0), (1, 0, 0)], "y int, a int, b int")
    out = M.champion_challenger(df, "y", "a", "b").collect()
    assert all(r["promote"] for r in out)
