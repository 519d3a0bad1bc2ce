"""Global orderings without a single-partition window.

Spark's ``Window.orderBy`` with no partition key moves every row into one
task.  The helpers here split the ordered domain into buckets whose count is
bounded (hash prefixes or approximate quantiles), total each bucket, turn the
bounded bucket table into offsets, and finish with a window *partitioned by
bucket*.  Every step is a partial aggregate, a bounded broadcast or a
balanced shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_col, hash_text
from tidemark.plans.joins import null_safe_join
from tidemark.session import materialize

PREFIX_HEX = 4  # 16^4 = 65,536 hash buckets: a proven bound for broadcast tables


def _offsets(bucket_totals: DataFrame, bucket_col: str, sum_cols: Sequence[str]) -> DataFrame:
    """Exclusive running sums over a bounded bucket table (<= 65,536 rows)."""
    w = Window.orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    out = bucket_totals
    for c in sum_cols:
        out = out.withColumn(f"_off_{c}", F.coalesce(F.sum(c).over(w), F.lit(0)))
    return out.select(bucket_col, *[f"_off_{c}" for c in sum_cols])


BUCKET_ROWS = 500_000  # rows that one task orders, about
MAX_BUCKETS = 65_536  # cuts the driver holds; buckets grow beyond that


def bucket_count(rows: int) -> int:
    return min(MAX_BUCKETS, 1 + rows // BUCKET_ROWS)


def _bucketed(df: DataFrame, key, buckets: int | None, out_col: str) -> DataFrame:
    """Numbers the rows by the quantile range of ``key``; as many ranges as the table's size asks for."""
    n = buckets or bucket_count(df.count())
    keyed = df.withColumn("_bucket_key", key)
    cuts = sorted({v for v in keyed.approxQuantile("_bucket_key", [i / n for i in range(1, n)], 0.1 / n) if v is not None}) if n > 1 else []
    if not cuts:
        return df.withColumn(out_col, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol="_bucket_key", outputCol=out_col, handleInvalid="keep").transform(keyed).drop("_bucket_key")


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                   buckets: int | None = None, out_prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order.

    ``df`` must hold one row per distinct ``order_col`` value (aggregate first),
    so ties share one row.  Buckets come from approximate quantiles, which only
    need to be deterministic, not exact; the result is exact.
    """
    key = "_rt_key"
    base = df.withColumn(key, (-F.col(order_col) if descending else F.col(order_col)).cast("double"))
    bucketed = _bucketed(base, F.col(key), buckets, "_rt_bucket")
    totals = bucketed.groupBy("_rt_bucket").agg(*[F.sum(c).alias(c) for c in sum_cols])
    offsets = _offsets(totals, "_rt_bucket", sum_cols)
    within = Window.partitionBy("_rt_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = bucketed.join(F.broadcast(offsets), "_rt_bucket")  # one row per bucket, MAX_BUCKETS at most
    for c in sum_cols:
        out = out.withColumn(f"{out_prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(within))
    return out.drop(key, "_rt_bucket", *[f"_off_{c}" for c in sum_cols])


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: str | int, rank_col: str = "_rank",
              hash_col: str = "_h") -> DataFrame:
    """0-based rank of each row in the order ``(md5(seed:keys), keys)``.

    The order is a seeded random permutation that DuckDB can reproduce with
    ``row_number() over (order by md5(...), keys)``.  Rows are bucketed by the
    first 4 hex digits of the hash (uniform, <= 65,536 buckets), so the final
    window is partitioned by bucket and balanced.  Keys are expected to
    identify rows; duplicated keys tie on the hash and share a bucket.
    """
    hashed = df.withColumn(hash_col, hash_text(seed, *key_cols)).withColumn(
        "_hb", F.substring(hash_col, 1, PREFIX_HEX))
    totals = hashed.groupBy("_hb").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(totals, "_hb", ["_n"])
    w = Window.partitionBy("_hb").orderBy(hash_col, *key_cols)
    return (hashed.join(F.broadcast(offsets), "_hb")
            .withColumn(rank_col, F.col("_off__n") + F.row_number().over(w) - F.lit(1))
            .drop("_hb", "_off__n"))


def _level_counts(hashed: DataFrame, level: int, prefix_filter) -> DataFrame:
    bucket = F.substring("_h", 1 + level * PREFIX_HEX, PREFIX_HEX)
    return hashed.filter(prefix_filter).groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))


def hash_cut(df: DataFrame, key_cols: Sequence[str], seed: str | int, k: int | None = None,
             fraction: float | None = None):
    """The k-th smallest ``(hash, keys)`` tuple, found from bounded histograms.

    Give ``k`` directly or ``fraction`` (k = ceil(fraction * n), with n taken
    from the first histogram - no separate count).  Returns ``(cut, n)``;
    ``cut`` is None for k <= 0.  Two levels of 65,536 hash-prefix buckets
    narrow the search to about n / 2^32 rows before a tiny sort, so no step
    ever orders the whole table.
    """
    hashed = df.select(hash_text(seed, *key_cols).alias("_h"), *key_cols)
    prefix_filter = F.lit(True)
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    n = None
    remaining = k
    for level in range(2):
        counts = _level_counts(hashed, level, prefix_filter)
        if level == 0:
            # One scan of the table; the <= 65,536-row histogram is kept in the checkpoint folder.
            counts = materialize(counts)
            counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy()))
            if remaining is None:
                total = counts.agg(F.sum("_n")).first()[0] or 0
                remaining = math.ceil(fraction * total - 1e-9)
        counts = counts.withColumn("_cum", F.sum("_n").over(w))
        if remaining is None or remaining <= 0:
            return None, n if n is not None else df.count()
        cut = (counts.filter((F.col("_cum") - F.col("_n") < remaining) & (F.col("_cum") >= remaining))
               .select("_b", (F.lit(remaining) - (F.col("_cum") - F.col("_n"))).alias("_r"),
                       *(["_total"] if level == 0 else []))
               .first())
        if cut is None:
            return None, n
        if level == 0:
            n = int(cut["_total"])
        remaining = int(cut["_r"])
        prefix_filter = prefix_filter & (F.substring("_h", 1 + level * PREFIX_HEX, PREFIX_HEX) == F.lit(cut["_b"]))
    tail = hashed.filter(prefix_filter).orderBy("_h", *key_cols).limit(remaining)
    last = tail.orderBy(*[F.col(c).desc() for c in ["_h", *key_cols]]).first()
    return tuple(last), n


def hash_bucket_totals(df: DataFrame, key_cols: Sequence[str], seed: str | int) -> tuple[DataFrame, int]:
    """Rows per hash-prefix bucket (<= 65,536 rows, checkpointed) and the table's row count."""
    bucket = F.substring(hash_text(seed, *key_cols), 1, PREFIX_HEX)
    totals = materialize(df.groupBy(bucket.alias("_hb")).agg(F.count(F.lit(1)).alias("_n")))
    return totals, int(totals.agg(F.sum("_n")).first()[0] or 0)


def rows_at_ranks(df: DataFrame, key_cols: Sequence[str], seed: str | int, wanted: DataFrame,
                  rank_col: str, totals: DataFrame, total: int) -> DataFrame:
    """Join ``wanted`` (one row per requested 0-based rank) to the rows holding those ranks
    in ``(md5(seed:keys), keys)`` order.

    Only hash buckets that hold a requested rank are ranked: the bucket of a
    rank is found by an equi-join on rank cells (each bucket expanded to the
    cells its rank interval touches, <= 2 x 65,536 rows), the source rows are
    semi-joined to the needed buckets (a bounded broadcast), and only those
    rows are shuffled into the per-bucket window.  For n draws that is about
    n / 65,536 of the table instead of all of it.  ``totals`` comes from
    ``hash_bucket_totals``.
    """
    hashed = df.withColumn("_h", hash_text(seed, *key_cols)).withColumn("_hb", F.substring("_h", 1, PREFIX_HEX))
    offsets = _offsets(totals, "_hb", ["_n"]).join(totals, "_hb").select(
        "_hb", F.col("_off__n").alias("_start"), (F.col("_off__n") + F.col("_n")).alias("_end"))
    cell = max(1, -(-int(total) // 16 ** PREFIX_HEX))
    cells = offsets.select("_hb", "_start", "_end", F.explode(F.sequence(
        F.floor(F.col("_start") / cell), F.floor((F.col("_end") - 1) / cell))).alias("_cell"))
    located = (wanted.withColumn("_cell", F.floor(F.col(rank_col) / cell))
               .join(F.broadcast(cells), "_cell")  # <= 2 x 65,536 rows
               .filter((F.col(rank_col) >= F.col("_start")) & (F.col(rank_col) < F.col("_end")))
               .drop("_cell", "_end"))
    needed = located.select("_hb", "_start").distinct()  # <= 65,536 rows
    w = Window.partitionBy("_hb").orderBy("_h", *key_cols)
    ranked = (hashed.join(F.broadcast(needed), "_hb")
              .withColumn(rank_col, F.col("_start") + F.row_number().over(w) - F.lit(1))
              .drop("_h", "_hb", "_start"))
    return located.drop("_hb", "_start").join(ranked, rank_col)


def range_ranks(df: DataFrame, group_col: str, order_col: str, out_col: str) -> DataFrame:
    """0-based place of each row in ``order_col`` order inside its group (no nulls, no ties).

    The rows are range-partitioned by group and order and written; a row's
    place is its partition's offset in the group plus its place inside, so
    only one row per group and partition is ever gathered.
    """
    ranged = materialize(df.repartitionByRange(group_col, order_col)).withColumn("_part", F.spark_partition_id())
    before = Window.partitionBy(group_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(group_col, "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        group_col, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group_col, "_part").orderBy(order_col)
    return (ranged.withColumn("_in", F.row_number().over(inside)).join(parts, [group_col, "_part"])
            .withColumn(out_col, F.col("_before") + F.col("_in") - 1).drop("_part", "_in", "_before"))


def tuple_leq(cols: Sequence[str | object], bound: Sequence[object]):
    """Lexicographic ``(cols) <= (bound)`` as one boolean Column; nulls are smallest, as in ``orderBy``."""
    cond = F.lit(True)
    for name, value in reversed(list(zip(cols, bound))):
        c = as_col(name)
        below = F.lit(False) if value is None else c.isNull() | (c < F.lit(value))
        cond = below | (c.eqNullSafe(F.lit(value)) & cond)
    return cond


def exact_quantile(df: DataFrame, group_cols: Sequence[str], value_col: str, q: float,
                   out_col: str = "quantile", distinct_col: str | None = None) -> DataFrame:
    """Exact ``quantile_cont`` per group, via a per-value histogram.

    Counting rows per (group, value) is a partial aggregate, so a hot group of
    repeated values collapses before the shuffle; the ordered window then runs
    over distinct values only, partitioned by group.  Optionally also returns
    the number of distinct values per group.
    """
    hist = (df.filter(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))
    return exact_quantile_hist(hist, group_cols, value_col, "_c", q, out_col, distinct_col)


def grouped_running_totals(df: DataFrame, group_cols: Sequence[str], order_col: str, sum_cols: Sequence[str],
                           buckets: int | None = None, prefix: str = "cum_", total_prefix: str = "tot_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order within each group,
    plus the group totals (``tot_<col>``); ``df`` has one row per (group, order value).

    The values are cut into buckets at quantiles of the whole table, whose
    number follows the table's size (``bucket_count``), and rows are ordered
    per (group, bucket).  A group with a third of all rows covers a third of
    the buckets at least, so no task orders a whole large group, and finding
    a row's bucket needs no join.  Offsets come from the bucket totals of each
    group.  A null group is a group like any other.
    """
    bucketed = _bucketed(df, F.col(order_col).cast("double"), buckets, "_bk")
    totals = bucketed.groupBy(*group_cols, "_bk").agg(*[F.sum(c).alias(f"_b_{c}") for c in sum_cols])
    before = Window.partitionBy(*group_cols).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = totals.select(
        *group_cols, "_bk",
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_b_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sum_cols])
    run = Window.partitionBy(*group_cols, "_bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = null_safe_join(bucketed, offsets, [*group_cols, "_bk"])
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(run))
    return out.drop("_bk", *[f"_off_{c}" for c in sum_cols])


def exact_quantile_hist(hist: DataFrame, group_cols: Sequence[str], value_col: str, count_col: str, q: float,
                        out_col: str = "quantile", distinct_col: str | None = None,
                        buckets: int | None = None) -> DataFrame:
    """``quantile_cont`` from a (group, value, count) histogram of non-null values, with the
    running counts from ``grouped_running_totals`` (no group is ordered in one task)."""
    h = (grouped_running_totals(hist, group_cols, value_col, [count_col], buckets, prefix="_cum_", total_prefix="_n_")
         .withColumnRenamed(f"_cum_{count_col}", "_cum").withColumnRenamed(f"_n_{count_col}", "_n")
         .withColumn("_pos", F.lit(float(q)) * (F.col("_n") - 1))
         .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos")))
    at = lambda idx: F.max(F.when((F.col("_cum") - F.col(count_col) <= F.col(idx)) & (F.col(idx) < F.col("_cum")),
                                  F.col(value_col)))
    aggs = [at("_lo").alias("_vlo"), at("_hi").alias("_vhi"), F.max("_pos").alias("_p"),
            F.max("_lo").alias("_l")]
    if distinct_col:
        aggs.append(F.count(F.lit(1)).alias(distinct_col))
    out = h.groupBy(*group_cols).agg(*aggs)
    out = out.withColumn(out_col, F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_p") - F.col("_l")))
    return out.drop("_vlo", "_vhi", "_p", "_l")
