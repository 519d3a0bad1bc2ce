"""Monitor profiles refreshed batch by batch from stored, mergeable states.

A full ``monitor_profile`` reads the whole monitoring table on every refresh.
Here each batch of new rows leaves two small delta tables behind, partitioned
by date and batch:

- ``moments``: per (window, model, column) the row and null counts, mean, sum of squared deviations,
  minimum and maximum, all of which merge exactly (deviations through the distance of each delta's mean from the merged one);
- ``values``: per (window, model, column, value) a count, which merges by addition and gives median and distinct values.

A refresh writes the batch's deltas, then rebuilds the profile of the dates it
touches from the deltas of these dates alone.  The scan is cut to the batch's
first and last date, and between them by a semi join with its distinct dates,
from which Spark prunes partitions at run time: only two dates pass the driver.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.monitor import GRANULARITY, KEYS, with_window
from tidemark.plans.joins import checked_small_side, null_safe_join
from tidemark.plans.ordered import exact_quantile_hist
from tidemark.session import materialize

DATE_COL, BATCH_COL = "date", "batch"
GROUP = [*KEYS, "column_name"]


def _parts(path: str) -> tuple[str, str, str]:
    root = path.rstrip("/")
    return f"{root}/moments", f"{root}/values", f"{root}/profile"


def _overwrite_parts(df: DataFrame, path: str, *cols: str) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (df.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


def batch_states(rows: DataFrame, ts: str, model: str, numeric_cols: Sequence[str],
                 granularity: str = GRANULARITY) -> tuple[DataFrame, DataFrame]:
    """The deltas of a batch: moments per (window, model, column), and counts per value of these."""
    parts = ", ".join(f"'{c}', cast(`{c}` as double)" for c in numeric_cols)
    long = with_window(rows, ts, model, granularity).selectExpr(*KEYS, f"stack({len(numeric_cols)}, {parts}) as (column_name, v)")
    moments = long.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v").isNull()).alias("n_null"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    values = long.filter(F.col("v").isNotNull()).groupBy(*GROUP, "v").agg(F.count(F.lit(1)).alias("c"))
    dated = lambda df: df.withColumn(DATE_COL, F.to_date("window_start"))
    return dated(moments), dated(values)


def merge_moments(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group from any number of deltas, whatever their order.

    With N = sum n_i and M = sum n_i mean_i / N, the deviations are sum m2_i + sum n_i (mean_i - M)^2.  Both steps
    share one shuffle on the keys.  A delta of nulls only has no mean and adds to the row counts alone.
    """
    n = F.col("n_rows") - F.col("n_null")
    w = Window.partitionBy(*keys)
    centred = deltas.withColumns({"_n": n, "_mean": F.sum(n * F.col("mean")).over(w) / F.nullif(F.sum(n).over(w), F.lit(0))})
    spread = F.col("m2") + F.col("_n") * F.pow(F.col("mean") - F.col("_mean"), 2)
    return centred.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.first("_mean").alias("mean"),
        F.when(F.sum("_n") > 1, F.sqrt(F.sum(spread) / (F.sum("_n") - 1))).alias("std"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))


def touched(stored: DataFrame, dates: DataFrame, low: datetime.date, high: datetime.date) -> DataFrame:
    """The stored rows of some dates, all within ``low`` and ``high``; the scan is pruned to these partitions."""
    within = F.col(DATE_COL).between(F.lit(low), F.lit(high))
    return stored.filter(within).join(dates.filter(within), DATE_COL, "left_semi")


def profile_of_states(moments: DataFrame, values: DataFrame, digits: int = 6) -> DataFrame:
    """The columns of ``monitor_profile`` and the date, from deltas."""
    keys = [DATE_COL, *GROUP]
    hist = materialize(values.groupBy(*keys, "v").agg(F.sum("c").alias("c")))
    middle = exact_quantile_hist(hist, keys, "v", "c", 0.5, out_col="median", distinct_col="n_distinct")
    out = null_safe_join(merge_moments(moments, keys), middle, keys, "left")
    return out.select(*keys, "n_rows", "n_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                      F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"),
                      "min_value", "max_value", F.round("median", digits).alias("median"))


def refresh_profile(spark: SparkSession, rows: DataFrame, ts: str, model: str, numeric_cols: Sequence[str], path: str,
                    batch: int, granularity: str = GRANULARITY, digits: int = 6) -> DataFrame:
    """Add a batch of new rows to the profiles at ``path`` and return all of them.

    ``batch`` names the batch: running one again with the same rows, as after a
    failure, replaces its own deltas and changes nothing.  Rows without a time
    are in no window.  Late rows only mean that an older date is touched.  An
    empty batch leaves the profiles as they are.
    """
    at_moments, at_values, at_profile = _parts(path)
    moments, values = batch_states(rows, ts, model, numeric_cols, granularity)
    moments = materialize(moments)
    low, high = moments.agg(F.min(DATE_COL), F.max(DATE_COL)).first()
    if low is None:
        return stored_profile(spark, path)
    dates = checked_small_side(moments.select(DATE_COL).distinct())
    tag = F.lit(int(batch))
    _overwrite_parts(moments.withColumn(BATCH_COL, tag), at_moments, DATE_COL, BATCH_COL)
    _overwrite_parts(values.withColumn(BATCH_COL, tag), at_values, DATE_COL, BATCH_COL)
    states = [touched(spark.read.schema(df.schema).option("basePath", at).parquet(at), dates, low, high)
              for df, at in ((moments, at_moments), (values, at_values))]
    _overwrite_parts(profile_of_states(*states, digits), at_profile, DATE_COL)
    return stored_profile(spark, path)


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """All profiles at ``path``; a monitor that was never refreshed has none, which is an error of the reader."""
    return spark.read.parquet(_parts(path)[2]).drop(DATE_COL)
