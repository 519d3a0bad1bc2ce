"""Synthetic rows that follow a source table's column profiles, with optional drift.

Every draw is a pure function of ``(seed, column, row index)`` (md5
uniforms), so a synthetic table is one projection over ``spark.range(n)``
plus broadcast lookups of bounded profile tables; it is identical on every
rerun and on any cluster size.  Profiles (mean/std, min/max, category
shares) are single aggregates of the source table.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampNTZType, TimestampType

from tidemark.functions.exprs import md5_normal, md5_uniform, nan_to_null
from tidemark.operators.sampling import bootstrap_sample
from tidemark.plans.joins import checked_small_side
from tidemark.session import materialize

CELLS = 65536  # equi-join cells for drawing categories by cumulative share


def category_counts(source: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per (column, category) of several columns from one scan."""
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = source.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, category)")
    return materialize(long.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("n")))


def share_table(source: DataFrame, col: str, counted: DataFrame | None = None) -> DataFrame:
    """Cumulative share interval ``[lo, hi)`` per category, categories in sorted order.

    Null is a category of its own (it is drawn as often as it occurs).  The
    categories are range-partitioned and written; each partition is summed,
    and running sums are the partition's offset plus the sum inside it, so any
    number of categories is ordered without one large task.  ``counted`` is
    the ``category_counts`` of a caller that needs several columns.
    """
    if counted is not None:
        of_type = F.col("category").cast(source.schema[col].dataType)
        counts = counted.filter(F.col("column_name") == col).select(of_type.alias("category"), "n")
    else:
        counts = source.groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.repartitionByRange(F.col("category").asc_nulls_first())).withColumn("_part", F.spark_partition_id())
    parts = counts.groupBy("_part").agg(F.sum("n").alias("_sum"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
                         F.sum("_sum").over(Window.partitionBy()).alias("_total"))
    inside = F.sum("n").over(Window.partitionBy("_part").orderBy(F.col("category").asc_nulls_first())
                             .rowsBetween(Window.unboundedPreceding, 0))
    out = counts.withColumn("_in", inside).join(F.broadcast(parts), "_part").withColumn("_cum", F.col("_before") + F.col("_in"))
    return materialize(out.select("category", ((F.col("_cum") - F.col("n")) / F.col("_total")).alias("lo"),
                                  (F.col("_cum") / F.col("_total")).alias("hi")))


def weights_table(spark: SparkSession, weights: Mapping[str, float]) -> DataFrame:
    """Fixed category weights (for drift injection) as a cumulative table, in the given order."""
    rows, acc = [], 0.0
    total = float(sum(weights.values()))
    for k, v in weights.items():
        rows.append((k, acc / total, (acc + v) / total))
        acc += v
    return spark.createDataFrame(rows, "category string, lo double, hi double")


def draw_category(draws: DataFrame, table: DataFrame, u: Column, out_col: str) -> DataFrame:
    """Pick the category whose ``[lo, hi)`` holds ``u``.

    Range join made equi: ``u`` falls in cell floor(u * CELLS); each category
    is expanded to the cells its interval touches (<= CELLS + categories rows,
    broadcast if measured small), and the exact interval test runs after the join.
    """
    cells = table.select("category", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS).cast("int"),
        F.least(F.floor(F.col("hi") * CELLS).cast("int"), F.lit(CELLS - 1)))).alias("_cell"))
    keyed = draws.withColumn("_u", u).withColumn("_cell", F.floor(F.col("_u") * CELLS).cast("int"))
    out = keyed.join(checked_small_side(cells), "_cell").filter((F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi")))
    return out.withColumnRenamed("category", out_col).drop("_cell", "_u", "lo", "hi")


def _rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "row_id")


def synth_categorical(spark: SparkSession, source: DataFrame, col: str, n: int, seed: int = 42) -> DataFrame:
    return draw_category(_rows(spark, n), share_table(source, col), md5_uniform(f"{seed}:{col}", F.col("row_id")), col)


def numeric_draw(mean: float | None, std: float | None, seed: int, col: str, floor: float | None = None,
                 digits: int | None = 6, factor: float | None = None) -> Column:
    """Normal(mean, sample std) by Box-Muller; optional floor (physical attributes)
    and drift factor, applied before the one final rounding."""
    if mean is None:
        value = F.lit(None).cast("double")
    else:
        value = F.lit(float(mean)) + F.lit(float(std or 0.0)) * md5_normal(f"{seed}:{col}", F.col("row_id"))
        if floor is not None:
            value = F.greatest(F.lit(float(floor)), value)
        if factor is not None:
            value = value * F.lit(float(factor))
    return F.round(value, digits) if digits is not None else value


def synth_numeric(spark: SparkSession, source: DataFrame, col: str, n: int, seed: int = 42,
                  floor: float | None = None) -> DataFrame:
    mean, std = column_profile(source, numeric=[col])[0][col]
    return _rows(spark, n).withColumn(col, numeric_draw(mean, std, seed, col, floor))


def timestamp_draw(lo_us: int | None, hi_us: int | None, seed: int, col: str) -> Column:
    """Uniform instant in [min, max) at microsecond grain; the minimum if min == max."""
    if lo_us is None:
        return F.lit(None).cast("timestamp_ntz")
    span = max(int(hi_us) - int(lo_us), 0)
    offset = F.floor(md5_uniform(f"{seed}:{col}", F.col("row_id")) * F.lit(span)) if span else F.lit(0)
    return F.timestamp_micros(F.lit(int(lo_us)) + offset.cast("long")).cast("timestamp_ntz")


def synth_timestamp(spark: SparkSession, source: DataFrame, col: str, n: int, seed: int = 42) -> DataFrame:
    lo, hi = column_profile(source, timestamps=[col])[1][col]
    return _rows(spark, n).withColumn(col, timestamp_draw(lo, hi, seed, col))


def synth_bootstrap(spark: SparkSession, source: DataFrame, key_cols: Sequence[str], col: str, n: int,
                    seed: int = 42) -> DataFrame:
    """Any other column type: values drawn from the existing rows with replacement."""
    sample = bootstrap_sample(spark, source.select(*key_cols, col), key_cols, n, seed=f"{seed}:{col}",
                              draw_col="row_id")
    return sample.select("row_id", col)


def synth_ids(spark: SparkSession, n: int, base: int) -> DataFrame:
    """String ids ``base + row``; the base (e.g. a load time in ms) is an argument."""
    return _rows(spark, n).withColumn("Id", (F.lit(int(base)) + F.col("row_id")).cast("string"))


def inject_drift(spark: SparkSession, df: DataFrame, scale_cols: Sequence[str], factor: float = 1.5,
                 redraw_col: str | None = None, weights: Mapping[str, float] | None = None,
                 seed: int = 42, digits: int | None = 6) -> DataFrame:
    """Scale numeric columns by ``factor`` and redraw one categorical with fixed weights."""
    out = df
    for c in scale_cols:
        scaled = F.col(c) * F.lit(float(factor))
        out = out.withColumn(c, F.round(scaled, digits) if digits is not None else scaled)
    if redraw_col and weights:
        out = draw_category(out.drop(redraw_col), weights_table(spark, weights),
                            md5_uniform(f"{seed}:drift:{redraw_col}", F.col("row_id")), redraw_col)
    return out


def column_profile(source: DataFrame, numeric: Sequence[str] = (), timestamps: Sequence[str] = ()
                   ) -> tuple[dict[str, tuple], dict[str, tuple]]:
    """Mean/std of numeric columns and min/max (epoch micros) of timestamp columns, in one aggregate."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    known = lambda c: nan_to_null(F.col(c).cast("double"))
    aggs = [e for c in numeric for e in (F.avg(known(c)).alias(f"{c}__m"), F.stddev_samp(known(c)).alias(f"{c}__s"))]
    aggs += [e for c in timestamps for e in (F.min(us(c)).alias(f"{c}__lo"), F.max(us(c)).alias(f"{c}__hi"))]
    if not aggs:
        return {}, {}
    row = source.agg(*aggs).first()
    return ({c: (row[f"{c}__m"], row[f"{c}__s"]) for c in numeric},
            {c: (row[f"{c}__lo"], row[f"{c}__hi"]) for c in timestamps})


def synth_table(spark: SparkSession, source: DataFrame, n: int, numeric: Sequence[str] = (),
                floored: Sequence[str] = (), categorical: Sequence[str] = (), timestamps: Sequence[str] = (),
                bootstrap: Sequence[str] = (), key_cols: Sequence[str] = (), base_id: int = 0,
                seed: int = 42, drift: bool = False, drift_scale: Sequence[str] = (),
                drift_col: str | None = None, drift_weights: Mapping[str, float] | None = None,
                floor: float = 0.1) -> DataFrame:
    """A whole synthetic table: numerics, categoricals, timestamps and
    bootstrapped columns, plus string ids, optionally with drift injected."""
    nums, tss = column_profile(source, list(numeric), list(timestamps))
    scale = set(drift_scale) if drift else set()
    out = _rows(spark, n).withColumns({
        **{c: numeric_draw(*nums[c], seed, c, floor if c in floored else None,
                           factor=1.5 if c in scale else None) for c in numeric},
        **{c: timestamp_draw(*tss[c], seed, c) for c in timestamps},
    })
    counted = category_counts(source, categorical) if len(categorical) > 1 else None
    for c in categorical:
        out = draw_category(out, share_table(source, c, counted), md5_uniform(f"{seed}:{c}", F.col("row_id")), c)
    for c in bootstrap:
        out = out.join(synth_bootstrap(spark, source, key_cols, c, n, seed), "row_id")
    out = out.withColumn("Id", (F.lit(int(base_id)) + F.col("row_id")).cast("string"))
    if drift:
        # Numeric drift was applied inside the draws (one rounding); scale the rest here.
        rest = [c for c in drift_scale if c not in numeric]
        out = inject_drift(spark, out, rest, 1.5, drift_col, drift_weights, seed)
    return out


# ---------------------------------------------------------------------------
# The reference pipeline's synthesis defaults.
# ---------------------------------------------------------------------------
DEFAULT_ROWS = 500
TEST_ROWS = 100
PHYSICAL_COLS = ("Height", "Weight")
PHYSICAL_FLOOR = 0.1
DRIFT_FACTOR = 1.5
DRIFT_GENDER_COL = "Gender"
DRIFT_GENDER_WEIGHTS = {"Male": 0.7, "Female": 0.3}
# ---------------------------------------------------------------------------


def generate_synthetic_data(spark: SparkSession, df: DataFrame, drift: bool = False, num_rows: int = DEFAULT_ROWS,
                            base_id: int | None = None, seed: int = 42, categorical: Sequence[str] = (),
                            key_cols: Sequence[str] = ("Id",)) -> DataFrame:
    """Synthetic rows shaped like ``df`` (the cleaned table), optionally with drift.

    Column roles follow the column types, as the reference does: numeric ->
    normal draws (physical attributes floored at 0.1), string -> categorical
    shares, timestamp -> uniform, anything else -> bootstrap of existing
    values.  Columns listed in ``categorical`` (e.g. a 0/1 target) are drawn
    by share instead of as normals.  ``Id`` is not modelled: new string ids
    are ``base_id + row`` (``base_id`` defaults to the current time in ms).
    """
    numeric, cats, stamps, other = [], [], [], []
    for f in df.schema.fields:
        if f.name in key_cols:
            continue
        if f.name in categorical or isinstance(f.dataType, StringType):
            cats.append(f.name)
        elif isinstance(f.dataType, NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            stamps.append(f.name)
        else:
            other.append(f.name)
    base = int(time.time() * 1000) if base_id is None else int(base_id)
    out = synth_table(spark, df, num_rows, numeric=numeric, floored=[c for c in PHYSICAL_COLS if c in numeric],
                      categorical=cats, timestamps=stamps, bootstrap=other, key_cols=list(key_cols), base_id=base,
                      seed=seed, drift=drift, drift_scale=[c for c in PHYSICAL_COLS if c in df.columns],
                      drift_col=DRIFT_GENDER_COL if DRIFT_GENDER_COL in df.columns else None,
                      drift_weights=DRIFT_GENDER_WEIGHTS, floor=PHYSICAL_FLOOR)
    return out.select(*[c for c in df.columns if c in out.columns])


def generate_test_data(spark: SparkSession, df: DataFrame, drift: bool = False, num_rows: int = TEST_ROWS,
                       **kwargs) -> DataFrame:
    return generate_synthetic_data(spark, df, drift, num_rows, **kwargs)
