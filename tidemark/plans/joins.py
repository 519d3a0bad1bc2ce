"""Joins whose small side is measured, and joins on keys that may be null.

A lookup table (rare values, category codes, cumulative shares) is usually
small, but nothing *proves* it: a high-cardinality column can make it as big
as the data.  ``lookup_join`` materialises the small side once in the shared
checkpoint folder, measures its rows and bytes in one aggregate, and
broadcasts it only under both bounds.  Above them it is a shuffle join, where
AQE's skew-join splitting handles a hot key on the big side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 32 << 20


def bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and, as text, ``max_bytes`` bytes."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= max_rows and (total or 0) <= max_bytes


def checked_small_side(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Checkpoint the small side and add the broadcast hint only if it is bounded."""
    small = materialize(small)
    return F.broadcast(small) if bounded(small, max_rows) else small


def lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
                max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    return big.join(checked_small_side(small, max_rows), on=on, how=how)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys appear once, as the left side has them
    (for a full outer join, whichever side has them)."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_right_{c}") if c in on else F.col(f"`{c}`") for c in right.columns],
                           F.lit(True).alias("_in_right"))
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(f"`{c}`").eqNullSafe(F.col(f"`_right_{c}`"))
    joined = left.withColumn("_in_left", F.lit(True)).join(renamed, cond, how)
    if how in ("full_outer", "full", "outer"):
        for c in on:
            joined = joined.withColumn(c, F.when(F.col("_in_left"), F.col(f"`{c}`")).otherwise(F.col(f"`_right_{c}`")))
    return joined.drop("_in_left", "_in_right", *[f"_right_{c}" for c in on])
