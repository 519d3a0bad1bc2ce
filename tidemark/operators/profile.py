"""Column profiles: numeric summary, table profile, date range, shares, distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import nan_to_null
from tidemark.session import materialize


def _stack(df: DataFrame, names: Sequence[str], groups: Sequence[Sequence[str]], out: Sequence[str],
           label: str = "column_name") -> DataFrame:
    """Unpivot one wide row: ``groups[i]`` are the columns of ``names[i]``."""
    parts = ", ".join(f"'{n}', " + ", ".join(f"`{c}`" for c in g) for n, g in zip(names, groups))
    return df.selectExpr(f"stack({len(names)}, {parts}) as ({label}, {', '.join(out)})")


def numeric_profile(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Mean and sample standard deviation per column; NaN and null skipped.

    One aggregation pass over all columns (partial aggregation, no shuffle of
    rows), unpivoted to ``(column_name, mean, std)``.
    """
    aggs = []
    for c in cols:
        v = nan_to_null(F.col(c).cast("double"))
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_samp(v).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    out = _stack(wide, cols, [[f"{c}__mean", f"{c}__std"] for c in cols], ["mean", "std"])
    if digits is not None:
        out = out.select("column_name", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"))
    return out


def table_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, non-null values and exact distinct values, as rows."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs += [F.count(F.col(c)).alias(f"{c}__nn"), F.count_distinct(F.col(c)).alias(f"{c}__nd")]
    wide = df.agg(*aggs)
    out = _stack(wide, cols, [["__rows", f"{c}__nn", f"{c}__nd"] for c in cols],
                 ["n_rows", "n_non_null", "n_distinct"])
    return out


def date_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max per date/timestamp column, as rows."""
    wide = df.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])
    return _stack(wide, cols, [[f"{c}__min", f"{c}__max"] for c in cols], ["min_value", "max_value"])


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Relative frequency of each non-null value.

    The grouped table is checkpointed once; the grand total is a scalar
    aggregate of it, so no single-partition window is needed.
    """
    counts = materialize(df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.withColumn("share", F.col("count") / F.lit(float(total)) if total else F.lit(None).cast("double"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
