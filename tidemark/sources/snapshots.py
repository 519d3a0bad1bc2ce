"""Versioned table snapshots, as-of reads and row-level change feeds, on plain parquet.

Each version lives in partition ``_version=N`` of one table folder, so an
as-of read is a partition-pruned scan and the latest version is a
metadata-sized aggregate.  The change feed between two versions is one full
outer join on the key with null-safe comparison of the other columns; that of
many versions is one shuffle by key and a walk over each key's versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.joins import lookup_join
from tidemark.sources.tables import is_name, write_target

VERSION_COL = "_version"
LOAD_TIME_COL = "update_timestamp_utc"


def with_load_time(df: DataFrame, load_time: Column | str | None = None, col: str = LOAD_TIME_COL) -> DataFrame:
    """Audit column with the load time: ``current_timestamp()`` (UTC session) unless given."""
    if load_time is None:
        ts = F.current_timestamp()
    elif isinstance(load_time, Column):
        ts = load_time
    else:
        ts = F.lit(load_time).cast("timestamp")
    return df.withColumn(col, ts)


def snapshot_overwrite(df: DataFrame, path: str, load_time: Column | str | None = None) -> None:
    """Full replace of a table (train/test tables are rewritten on every run), stamped with the load time."""
    write_target(with_load_time(df, load_time).write.mode("overwrite"), path)


def save_train_test(split: DataFrame, base_path: str, split_col: str = "split",
                    load_time: Column | str | None = None) -> tuple[str, str]:
    """Write the two sides of a split as ``train`` and ``test`` tables (overwrite)."""
    base = base_path.rstrip("/")
    paths = (f"{base}_train", f"{base}_test") if is_name(base) else (f"{base}/train", f"{base}/test")
    for side, path in zip(("train", "test"), paths):
        snapshot_overwrite(split.filter(F.col(split_col) == side).drop(split_col), path, load_time)
    return paths


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Add (or replace) one version; other versions are untouched (dynamic partition overwrite)."""
    (df.withColumn(VERSION_COL, F.lit(int(version)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(VERSION_COL).parquet(path))


def latest_version(spark: SparkSession, path: str) -> int | None:
    return spark.read.parquet(path).agg(F.max(VERSION_COL)).first()[0]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of one version (latest if None); the filter prunes to one partition."""
    v = latest_version(spark, path) if version is None else version
    return spark.read.parquet(path).filter(F.col(VERSION_COL) == F.lit(int(v))).drop(VERSION_COL)


def change_feed(old: DataFrame, new: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Row changes from ``old`` to ``new``: insert, delete, update_preimage, update_postimage.

    Unchanged rows are dropped; comparison is null-safe (``<=>``).  One full
    outer join (shuffled on the key); each changed key emits its rows with
    ``inline`` instead of a second pass.
    """
    value_cols = [c for c in new.columns if c not in key_cols]
    o = old.select(*key_cols, F.struct(*value_cols).alias("_o"), F.lit(True).alias("_in_old"))
    n = new.select(*key_cols, F.struct(*value_cols).alias("_n"), F.lit(True).alias("_in_new"))
    j = o.join(n, list(key_cols), "full_outer")
    row = lambda side, kind: F.struct(*[F.col(c) for c in key_cols],
                                      *[F.col(f"{side}.{c}").alias(c) for c in value_cols],
                                      F.lit(kind).alias("_change_type"))
    changed = ~F.col("_o").eqNullSafe(F.col("_n"))
    events = (F.when(F.col("_in_old").isNull(), F.array(row("_n", "insert")))
              .when(F.col("_in_new").isNull(), F.array(row("_o", "delete")))
              .when(changed, F.array(row("_o", "update_preimage"), row("_n", "update_postimage"))))
    return j.select(F.inline(events))


def change_history(snapshots: DataFrame, key_cols: Sequence[str], version_col: str = VERSION_COL,
                   from_start: bool = False) -> DataFrame:
    """All row changes between consecutive versions of a table, with the version that made them.

    ``snapshots`` holds the rows of every version.  Each version's neighbours come from the distinct labels, which may
    have gaps; each key's rows are ordered by version in one window on the key.  Where a key's neighbouring row is not
    of the neighbouring version the key was away: it was deleted in the version after the last one that had it, and
    inserted again where it returns.  A key is unique within a version, so a group has at most one row per version;
    null keys are keys.  Rows of the first version count as inserts only with ``from_start``.  A version without any
    row is not seen.
    """
    keys = list(key_cols)
    columns = [c for c in snapshots.columns if c != version_col]
    in_order = Window.orderBy(version_col)  # one row per whole snapshot
    chain = snapshots.select(version_col).distinct().select(
        version_col, F.lag(version_col).over(in_order).alias("_earlier"), F.lead(version_col).over(in_order).alias("_later"))
    walk = Window.partitionBy(*keys).orderBy(version_col)
    rows = lookup_join(snapshots.select(version_col, *keys, F.struct(*columns).alias("_row")), chain, version_col)
    rows = rows.withColumns({"_before": F.lag("_row").over(walk), "_seen": F.lag(version_col).over(walk),
                             "_next": F.lead(version_col).over(walk)})
    follows = F.col("_seen").eqNullSafe(F.col("_earlier")) & F.col("_earlier").isNotNull()
    first = F.lit(from_start) | F.col("_earlier").isNotNull()
    leaves = F.col("_later").isNotNull() & ~F.col("_next").eqNullSafe(F.col("_later"))
    event = lambda row, kind, version: F.struct(F.col(row).alias("_row"), F.lit(kind).alias("_change_type"), F.col(version).alias("_version"))
    came = (F.when(follows & ~F.col("_row").eqNullSafe(F.col("_before")),
                   F.array(event("_before", "update_preimage", version_col), event("_row", "update_postimage", version_col)))
            .when(~follows & first, F.array(event("_row", "insert", version_col))))
    went = F.when(leaves, F.array(event("_row", "delete", "_later")))
    none = F.slice(F.array(event("_row", "", version_col)), 1, 0)
    events = rows.select(F.inline(F.concat(F.coalesce(came, none), F.coalesce(went, none))).alias("_row", "_change_type", "_at"))
    return events.select("_row.*", "_change_type", F.col("_at").alias(version_col))
