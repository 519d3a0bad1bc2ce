"""Category coding learned on training rows; unknown or missing values code to -1.

MLlib's ``StringIndexer(handleInvalid="keep")`` gives unseen values the code
k instead of -1, so the codes are an explicit table joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.joins import MAX_BROADCAST_ROWS, bounded
from tidemark.plans.ordered import range_ranks

UNKNOWN_CODE = -1


def fit_category_codes(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, category, code)``: sorted categories of each column -> 0..k-1.

    One pass unpivots the columns, ``distinct`` is a partial aggregate, and
    the distinct table is range-partitioned to number its rows, so a column
    with many categories is not ordered in one task.
    """
    if not cols:
        return train.sparkSession.createDataFrame([], "column_name string, category string, code int")
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = train.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, category)")
    cats = long.filter(F.col("category").isNotNull()).distinct()
    return range_ranks(cats, "column_name", "category", "code").withColumn("code", F.col("code").cast("int"))


def apply_category_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str], suffix: str = "",
                         max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace each column (or add ``col + suffix``) by its code, -1 when unseen or null."""
    table = F.broadcast(codes) if bounded(codes, max_broadcast_rows) else codes
    out = df
    for c in cols:
        lookup = table.filter(F.col("column_name") == c).select(
            F.col("category").alias(f"_cat_{c}"), F.col("code").alias(f"_code_{c}"))
        out = out.join(lookup, F.col(c).cast("string") == F.col(f"_cat_{c}"), "left")
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"_code_{c}"), F.lit(UNKNOWN_CODE))).drop(
            f"_cat_{c}", f"_code_{c}")
    return out


def feature_vector(df: DataFrame, coded_cols: Sequence[str], numeric_cols: Sequence[str],
                   out_col: str = "features") -> DataFrame:
    """Coded categories first, numeric columns passed through (nulls kept as NaN)."""
    assembler = VectorAssembler(inputCols=[*coded_cols, *numeric_cols], outputCol=out_col, handleInvalid="keep")
    return assembler.transform(df)
