"""Exact binary-classification metrics as Spark aggregates.

Counts use ``count_if`` in one pass (optionally grouped, e.g. per A/B arm or
per monitoring window).  ROC AUC and PR AUC aggregate to one row per distinct
score, then take distributed running totals (``plans.ordered.running_totals``)
- never a single-partition window over the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordered import running_totals
from tidemark.session import materialize


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (),
                     also: Sequence[Column] = ()) -> DataFrame:
    """Confusion counts, per group if ``by`` is given; ``also`` adds aggregates of the same pass."""
    y, p = _c(label), _c(prediction)
    aggs = [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        *also,
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def rates(cm: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1 from confusion counts; 0/0 -> null.

    F1 = 2tp / (2tp + fp + fn), which equals 2PR/(P+R) and reproduces the
    published golden value to the last digit.
    """
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return cm.withColumns({
        "accuracy": F.try_divide(tp + tn, tp + fp + tn + fn),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn),
    })


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return rates(confusion_matrix(df, label, prediction, by))


def log_loss(df: DataFrame, label: str, score: str, eps: float = 1e-15, by: Sequence[str] = ()) -> DataFrame:
    """Mean negative log-likelihood with the probability clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(_c(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = _c(label).cast("double")
    term = -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))
    agg = F.avg(term).alias("log_loss")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    y = _c(label)
    return (df.filter(_c(score).isNotNull())
            .groupBy(_c(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def curve_areas(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (trapezoid, ties share one step) and PR AUC (average precision).

    Thresholds run from the highest score down.  With cumulative positives
    ``TP_i`` and negatives ``FP_i`` at each distinct score:
    ROC AUC = sum(neg_i * (TP_i - pos_i / 2)) / (P * N),
    AP      = sum(pos_i / P * TP_i / (TP_i + FP_i)).
    """
    table = materialize(score_table(df, label, score))  # one scan of the scored rows
    cum = running_totals(table, "score", ["pos", "neg"], descending=True, buckets=buckets)
    terms = cum.select(
        (F.col("neg") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))).alias("_roc"),
        (F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_ap"),
        "pos", "neg")
    sums = terms.agg(F.sum("_roc").alias("_roc"), F.sum("_ap").alias("_ap"),
                     F.sum("pos").cast("double").alias("_p"), F.sum("neg").cast("double").alias("_n"))
    return sums.select(F.try_divide(F.col("_roc"), F.col("_p") * F.col("_n")).alias("roc_auc"),
                       F.try_divide(F.col("_ap"), F.col("_p")).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_areas(df, label, score).select("roc_auc")


def pr_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_areas(df, label, score).select("pr_auc")


METRIC_ORDER = ("tp", "fp", "tn", "fn", "n", "accuracy", "precision", "recall", "f1", "log_loss",
                "roc_auc", "pr_auc")


def _unpivot(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    parts = ", ".join(f"'{n}', cast(`{n}` as double)" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {parts}) as (metric, value)")


def evaluate(df: DataFrame, label: str, prediction: str, score: str | None = None, digits: int = 9) -> DataFrame:
    """All metrics as ``(metric, value)`` rows (the tracking server's EAV shape).

    Each family is its own one-row aggregate; the unpivoted rows are unioned.
    With a score the scored columns are written once first, so scoring runs once.
    """
    if score is not None:
        df = materialize(df.select(label, prediction, score))
    long = _unpivot(classification_metrics(df, label, prediction),
                    ["tp", "fp", "tn", "fn", "n", "accuracy", "precision", "recall", "f1"])
    if score is not None:
        long = (long.unionByName(_unpivot(log_loss(df, label, score), ["log_loss"]))
                .unionByName(_unpivot(curve_areas(df, label, score), ["roc_auc", "pr_auc"])))
    return long.withColumn("value", F.round("value", digits))


def champion_challenger(df: DataFrame, label: str, champion: str, challenger: str) -> DataFrame:
    """Both models on the same rows; metrics side by side; promote iff F1 >= champion's.

    A null champion F1 (no model yet) promotes the challenger.  The promote
    flag is a window over the four joined metric rows.
    """
    both = df.selectExpr(f"`{label}` as _label", f"stack(2, 'champion', `{champion}`, 'challenger', `{challenger}`) as (_model, _prediction)")
    names = ["accuracy", "precision", "recall", "f1"]
    rates = classification_metrics(both, "_label", "_prediction", by=["_model"])  # one scan for both models
    parts = ", ".join(f"'{n}', cast(`{n}` as double)" for n in names)
    long = rates.selectExpr("_model", f"stack({len(names)}, {parts}) as (metric, value)")
    of = lambda model: F.max(F.when(F.col("_model") == model, F.col("value"))).alias(model)
    side = long.groupBy("metric").agg(of("champion"), of("challenger"))
    wins = F.when(F.col("metric") == "f1",
                  (F.col("challenger") >= F.col("champion")) | F.col("champion").isNull())
    return side.withColumn("promote", F.max(wins).over(Window.partitionBy()))
