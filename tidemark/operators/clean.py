"""Cleaning a raw entity table: renames, fills, flags, lumping of rare values, filters.

``clean_table`` keeps the reference's step order exactly: rare universes are
counted before any row filter, keyword flags read Origin before it is
normalised, and "human" wins over "mutant".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.plans.joins import MAX_BROADCAST_ROWS, lookup_join

# Raw column names of the character table and their clean names.
RAW_RENAMES = {"Height (m)": "Height", "Weight (kg)": "Weight", "Marital Status": "Marital_Status"}
ID_RAW, ID_CLEAN = "PageID", "Id"
DEFAULT_NUM = ("Height", "Weight")
DEFAULT_CAT = ("Universe", "Identity", "Gender", "Marital_Status", "Teams", "Origin", "Magic", "Mutant")
DEFAULT_TARGET = "Alive"
RARE_THRESHOLD = 50


def rename_select(df: DataFrame, renames: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Rename columns, then keep ``keep`` in that order (all columns if None)."""
    out = df.withColumnsRenamed(dict(renames))
    return out.select(*keep) if keep is not None else out


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), F.col(col)))


def rare_values(df: DataFrame, col: str, threshold: int) -> DataFrame:
    """Values seen fewer than ``threshold`` times (partial aggregation absorbs hot values)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") < threshold).select(col, F.lit(True).alias("_rare")))


def rare_to_other(df: DataFrame, col: str, threshold: int, other: str = X.OTHER,
                  counted_on: DataFrame | None = None,
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace values with fewer than ``threshold`` rows by ``other``.

    Counts come from ``counted_on`` (default ``df``) so a caller can count
    before filtering.  The rare table joins back through a size-checked
    broadcast rather than a ``count() over (partition by col)`` window, which
    would put a dominant value's rows into one task.
    """
    rare = rare_values(counted_on if counted_on is not None else df, col, threshold)
    joined = lookup_join(df, rare, on=col, how="left", max_rows=max_broadcast_rows)
    return joined.withColumn(col, F.when(F.col("_rare"), F.lit(other)).otherwise(F.col(col))).drop("_rare")


def clean_table(raw: DataFrame, num_features: Sequence[str] = DEFAULT_NUM,
                cat_features: Sequence[str] = DEFAULT_CAT, target: str = DEFAULT_TARGET,
                rare_threshold: int = RARE_THRESHOLD) -> DataFrame:
    """The full cleaning chain of the raw character table (one lazy plan)."""
    df = raw.withColumnsRenamed({k: v for k, v in RAW_RENAMES.items() if k in raw.columns})
    df = df.withColumn("Universe", X.fill_unknown("Universe"))
    # Rare universes are counted on every row, before the filters below.
    df = rare_to_other(df, "Universe", rare_threshold)
    df = df.withColumns({
        "Teams": X.presence_flag("Teams"),
        "Origin": X.fill_unknown("Origin"),
        "Identity": X.fill_unknown("Identity"),
    })
    df = df.filter(F.col("Identity").isin(list(X.IDENTITY_VALUES)))
    df = df.withColumns({
        "Gender": X.whitelist_other(X.fill_unknown("Gender"), X.GENDER_VALUES),
        "Marital_Status": X.replace_value(X.fill_unknown("Marital_Status"), "Widow", "Widowed"),
    })
    df = df.filter(F.col("Marital_Status").isin(list(X.MARITAL_VALUES)))
    df = df.withColumns({
        "Magic": X.keyword_flag("Origin", X.MAGIC_KEYWORDS),
        "Mutant": X.keyword_flag("Origin", X.MUTANT_KEYWORDS),
    })
    df = df.withColumn("Origin", X.keyword_category("Origin", X.ORIGIN_RULES))
    df = df.filter(F.col(target).isin(list(X.ALIVE_VALUES)))
    df = df.withColumn(target, X.binary_target(target, "Alive"))
    df = df.select(*num_features, *cat_features, target, F.col(ID_RAW).cast("string").alias(ID_CLEAN))
    return df.withColumns({c: F.col(c).cast("double") for c in num_features})


def scan_raw_characters(spark, path: str) -> DataFrame:
    """Read the raw character CSV with a fixed schema and pandas' missing-value tokens."""
    from tidemark.sources.csv import csv_scan
    schema = ("PageID long, `Height (m)` double, `Weight (kg)` double, Universe string, Teams string, "
              "Origin string, Identity string, Gender string, `Marital Status` string, Alive string")
    return csv_scan(spark, path, schema)
