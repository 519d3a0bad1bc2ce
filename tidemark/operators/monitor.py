"""Inference-log monitoring: windowed profiles and drift between consecutive windows.

Grouping keys are ``(window_start, model)``; every heavy step is a partial
aggregate over the monitoring rows.  Ordered steps (previous window, running
value counts) run on the aggregated tables, partitioned by model or by
(model, window), never globally.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import classification_metrics
from tidemark.plans.joins import null_safe_join
from tidemark.plans.ordered import exact_quantile_hist, grouped_running_totals
from tidemark.session import materialize

GRANULARITY = "30 minutes"
KEYS = ["window_start", "window_end", "model"]


def with_window(df: DataFrame, ts: str, model: str, granularity: str = GRANULARITY) -> DataFrame:
    w = F.window(F.col(ts), granularity)
    return df.withColumns({"window_start": w.start, "window_end": w.end, "model": F.col(model)})


def monitor_profile(df: DataFrame, ts: str, model: str, numeric_cols: Sequence[str],
                    granularity: str = GRANULARITY, digits: int = 6) -> DataFrame:
    """Per window, model and numeric column: rows, nulls, distinct values, mean,
    sample std, min, max and exact median.
    """
    base = with_window(df, ts, model, granularity)
    parts = ", ".join(f"'{c}', cast(`{c}` as double)" for c in numeric_cols)
    long = base.selectExpr(*KEYS, f"stack({len(numeric_cols)}, {parts}) as (column_name, v)")
    keys = KEYS + ["column_name"]
    # What merges comes from one partial aggregate over the rows; the histogram is for the median and the distinct values only.
    stats = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v").isNull()).alias("n_null"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    hist = materialize(long.filter(F.col("v").isNotNull()).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c")))
    med = exact_quantile_hist(hist, keys, "v", "c", 0.5, out_col="median", distinct_col="n_distinct")
    out = null_safe_join(stats, med, keys, "left")
    return out.select(*keys, "n_rows", "n_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                      F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"),
                      "min_value", "max_value", F.round("median", digits).alias("median"))


def monitor_profile_categorical(df: DataFrame, ts: str, model: str, cat_cols: Sequence[str],
                                granularity: str = GRANULARITY, digits: int = 6) -> DataFrame:
    """Per window, model and categorical column: rows, nulls, distinct values and the
    most frequent value with its share of the non-null rows (ties: the larger value).

    One scan into per-(group, value) counts (checkpointed); the top value is
    ``max`` of the (count, value) struct - a partial aggregate, no sort.
    """
    base = with_window(df, ts, model, granularity)
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cat_cols)
    long = base.selectExpr(*KEYS, f"stack({len(cat_cols)}, {parts}) as (column_name, v)")
    keys = KEYS + ["column_name"]
    counts = materialize(long.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c")))
    top = F.max(F.when(F.col("v").isNotNull(), F.struct(F.col("c").alias("c"), F.col("v").alias("v"))))
    out = counts.groupBy(*keys).agg(
        F.sum("c").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("n_null"),
        F.count("v").alias("n_distinct"),
        top.alias("_top"))
    return out.select(*keys, "n_rows", "n_null", "n_distinct", F.col("_top.v").alias("top_value"),
                      F.col("_top.c").alias("top_count"),
                      F.round(F.try_divide(F.col("_top.c"), F.col("n_rows") - F.col("n_null")), digits)
                      .alias("top_share"))


def monitor_quality(df: DataFrame, ts: str, model: str, label: str, prediction: str,
                    granularity: str = GRANULARITY) -> DataFrame:
    """Classification quality per window and model once ground-truth labels are joined
    to the monitoring rows: confusion counts, accuracy, precision, recall, F1."""
    return classification_metrics(with_window(df, ts, model, granularity), label, prediction, by=KEYS)


def monitor_prediction_mix(df: DataFrame, ts: str, model: str, prediction: str,
                           granularity: str = GRANULARITY) -> DataFrame:
    """Class mix of predictions per window and model, with the share inside the window."""
    counts = (with_window(df, ts, model, granularity)
              .groupBy(*KEYS, F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("window_start", "model")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(w))


def _window_chain(counts: DataFrame) -> DataFrame:
    """(model, window_start) -> previous filled window of the same model."""
    wins = counts.select("model", "window_start").distinct()
    w = Window.partitionBy("model").orderBy("window_start")
    return wins.withColumn("prev_start", F.lag("window_start").over(w))


def _against(shares: DataFrame, chain: DataFrame, baseline: DataFrame | None, carry: Sequence[str]) -> DataFrame:
    """What each window is compared with, keyed by that window: the rows of its predecessor, or of its model's baseline."""
    if baseline is not None:
        return null_safe_join(chain.select("model", "window_start", "prev_start"), baseline.select("model", *carry), ["model"])
    follows = chain.filter(F.col("prev_start").isNotNull()).select("model", F.col("prev_start").alias("_start"), F.col("window_start").alias("_next"))
    before = shares.withColumnRenamed("window_start", "_start").select("model", "_start", *carry)
    return (null_safe_join(before, follows, ["model", "_start"])
            .select("model", F.col("_next").alias("window_start"), F.col("_start").alias("prev_start"), *carry))


def monitor_drift_categorical(df: DataFrame, ts: str, model: str, col: str,
                              granularity: str = GRANULARITY, eps: float = 1e-4, digits: int = 6,
                              baseline: DataFrame | None = None) -> DataFrame:
    """Shares of ``col`` in each window against the previous filled window of the model, or,
    with ``baseline`` (columns ``model`` and ``col``), against that table's shares of the model.

    Categories missing on one side count as share 0 (full outer join).
    total_variation = 1/2 sum|p - q|; js = Jensen-Shannon divergence (natural log);
    psi = sum (p' - q') ln(p'/q') and chi2 = sum (n_p - N_p q')^2 / (N_p q') with
    shares floored at ``eps``.  A window with nothing to compare it with gets null
    metrics; ``prev_start`` is null against a baseline.  A null model is a model of its own.
    """
    base = with_window(df, ts, model, granularity).withColumn("category", F.col(col).cast("string"))
    # One scan of the monitoring rows; every later step reads this small checkpointed table.
    counts = materialize(base.groupBy("model", "window_start", "category").agg(F.count(F.lit(1)).alias("n")))
    known = None
    if baseline is not None:
        per = baseline.groupBy(F.col(model).alias("model"), F.col(col).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"))
        known = null_safe_join(per, per.groupBy("model").agg(F.sum("n").alias("total")), ["model"])
        known = materialize(known.withColumn("share", F.col("n") / F.col("total")))
    return drift_of_counts(counts, known, eps, digits)


def drift_of_counts(counts: DataFrame, known: DataFrame | None = None, eps: float = 1e-4, digits: int = 6) -> DataFrame:
    """``monitor_drift_categorical`` from counts that are there already (``model``, ``window_start``, ``category``, ``n``).

    ``known`` holds the shares of a baseline (``model``, ``category``, ``share``).
    """
    totals = counts.groupBy("model", "window_start").agg(F.sum("n").alias("total"))
    shares = null_safe_join(counts, totals, ["model", "window_start"]).withColumn("share", F.col("n") / F.col("total"))
    chain = _window_chain(counts)
    if known is not None:
        chain = chain.withColumn("prev_start", F.lit(None).cast(chain.schema["window_start"].dataType))
    prev = _against(shares, chain, known, ["category", "share"]).withColumnRenamed("share", "q")
    compared = prev.select("model", "window_start", "prev_start").distinct()
    cur = null_safe_join(shares.select("model", "window_start", "category", F.col("n").alias("n_cur"), F.col("share").alias("p")),
                         compared, ["model", "window_start"])
    pairs = null_safe_join(cur, prev, ["model", "window_start", "prev_start", "category"], "full_outer").fillna(
        {"p": 0.0, "q": 0.0, "n_cur": 0})
    pairs = null_safe_join(pairs, totals.withColumnRenamed("total", "n_window"), ["model", "window_start"])
    p, q = F.col("p"), F.col("q")
    m = (p + q) / F.lit(2.0)
    pf, qf = F.greatest(p, F.lit(eps)), F.greatest(q, F.lit(eps))
    expected = F.col("n_window") * qf
    kl = lambda a: F.when(a > 0, a * F.ln(a / m)).otherwise(F.lit(0.0))
    names = ("total_variation", "js_divergence", "psi", "chi2")
    metrics = pairs.groupBy("model", "window_start").agg(
        F.sum(F.abs(p - q) / F.lit(2.0)).alias("total_variation"),
        F.sum((kl(p) + kl(q)) / F.lit(2.0)).alias("js_divergence"),
        F.sum((pf - qf) * F.ln(pf / qf)).alias("psi"),
        F.sum(F.pow(F.col("n_cur") - expected, 2) / expected).alias("chi2"))
    out = null_safe_join(chain, metrics, ["model", "window_start"], "left")
    return out.select("model", "window_start", "prev_start", *[F.round(c, digits).alias(c) for c in names])


def monitor_drift_numeric(df: DataFrame, ts: str, model: str, col: str,
                          granularity: str = GRANULARITY, digits: int = 6,
                          baseline: DataFrame | None = None) -> DataFrame:
    """Mean / std shift and the two-sample KS statistic against the previous filled window,
    or, with ``baseline`` (columns ``model`` and ``col``), against that table's rows of the model.

    KS = max |F_cur(x) - F_prev(x)| over the union of observed values, from
    per-value counts (partial aggregate) and running sums per (model, window)
    that are split into value buckets (``grouped_running_totals``), so a busy
    window is not ordered in one task.  Mean and std come from one partial
    aggregate over the rows.  A null model is a model of its own.
    """
    value = F.col(col).cast("double")
    base = with_window(df, ts, model, granularity).withColumn("v", value).filter(F.col("v").isNotNull())
    moments = (F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    stats = materialize(base.groupBy("model", "window_start").agg(*moments))
    # Repeated values collapse into a histogram; only the KS curves need it.
    hist = materialize(base.groupBy("model", "window_start", "v").agg(F.count(F.lit(1)).alias("c")))
    known = known_stats = None
    if baseline is not None:
        rows = baseline.select(F.col(model).alias("model"), value.alias("v")).filter(F.col("v").isNotNull())
        known = materialize(rows.groupBy("model", "v").agg(F.count(F.lit(1)).alias("c")))
        known_stats = rows.groupBy("model").agg(*moments)
    return drift_of_values(stats, hist, known, known_stats, digits)


def drift_of_values(stats: DataFrame, hist: DataFrame, known: DataFrame | None = None, known_stats: DataFrame | None = None,
                    digits: int = 6) -> DataFrame:
    """``monitor_drift_numeric`` from moments (``model``, ``window_start``, ``mean``, ``std``) and per-value counts
    (``model``, ``window_start``, ``v``, ``c``) that are there already; ``known`` and ``known_stats`` are a baseline's, per model.
    """
    chain = _window_chain(stats)
    if known is not None:
        chain = chain.withColumn("prev_start", F.lit(None).cast(chain.schema["window_start"].dataType))
    before = _against(hist, chain, known, ["v", "c"])
    compared = before.select("model", "window_start").distinct()
    zero = F.lit(0).cast("long")
    cur_side = null_safe_join(hist, compared, ["model", "window_start"]).select(
        "model", "window_start", "v", F.col("c").alias("c_cur"), zero.alias("c_prev"))
    prev_side = before.select("model", "window_start", "v", zero.alias("c_cur"), F.col("c").alias("c_prev"))
    merged = materialize(cur_side.unionByName(prev_side).groupBy("model", "window_start", "v")
                         .agg(F.sum("c_cur").alias("c_cur"), F.sum("c_prev").alias("c_prev")))
    run = grouped_running_totals(merged, ["model", "window_start"], "v", ["c_cur", "c_prev"])
    gaps = run.select("model", "window_start",
                      F.abs(F.col("cum_c_cur") / F.col("tot_c_cur") - F.col("cum_c_prev") / F.col("tot_c_prev")).alias("gap"))
    ks = gaps.groupBy("model", "window_start").agg(F.max("gap").alias("ks"))
    prev_stats = _against(stats, chain, known_stats, ["mean", "std"]).select(
        "model", "window_start", F.col("mean").alias("mean_prev"), F.col("std").alias("std_prev"))
    out = null_safe_join(null_safe_join(stats, chain, ["model", "window_start"]), prev_stats, ["model", "window_start"], "left")
    out = null_safe_join(out, ks, ["model", "window_start"], "left")
    return out.select(
        "model", "window_start", "prev_start",
        F.round("mean", digits).alias("mean_cur"), F.round("mean_prev", digits).alias("mean_prev"),
        F.round(F.col("mean") - F.col("mean_prev"), digits).alias("mean_shift"),
        F.round("std", digits).alias("std_cur"), F.round("std_prev", digits).alias("std_prev"),
        F.round("ks", digits).alias("ks"))


def at_granularities(profile: Callable[..., DataFrame], df: DataFrame, ts: str, model: str, column, granularities: Sequence[str],
                     **arguments) -> DataFrame:
    """Any profile or drift function of this module at several window lengths, told apart by ``granularity``."""
    parts = [profile(df, ts, model, column, granularity=g, **arguments).withColumn("granularity", F.lit(g)) for g in granularities]
    return reduce(DataFrame.unionByName, parts)
