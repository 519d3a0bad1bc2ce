"""As-of joins: for each row, the last row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.joins import null_safe_join
from tidemark.session import materialize


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, carry: Sequence[str]) -> DataFrame:
    """``left`` with ``right_time`` and ``carry`` of the last ``right`` row of the same ``by`` at or before ``left_time``.

    The answer depends on (``by``, time) only, so both sides are first reduced to their distinct times.  These are
    range-partitioned by (``by``, time): a key with a third of all rows spreads over a third of the partitions.  Inside
    a partition the last right row is carried forward; what a partition's end hands on to the next one of the same key
    is a table of one row per key and partition.  Null keys are a key.  Of right rows at one time the largest
    ``carry`` counts; right rows without a time are none; left rows without a time, or before all right rows, get nulls.
    """
    by = list(by)
    probes = left.filter(F.col(left_time).isNotNull()).select(*by, F.col(left_time).alias("_time")).distinct()
    points = right.filter(F.col(right_time).isNotNull()).groupBy(*by, F.col(right_time).alias("_time")).agg(
        F.max(F.struct(*carry)).alias("_found"))
    found_type = points.schema["_found"].dataType
    events = (points.select(*by, "_time", "_found", F.lit(False).alias("_asked"))
              .unionByName(probes.select(*by, "_time", F.lit(None).cast(found_type).alias("_found"), F.lit(True).alias("_asked"))))
    times = events.groupBy(*by, "_time").agg(F.max("_found").alias("_found"), F.max("_asked").alias("_asked")).withColumn(
        "_hit", F.when(F.col("_found").isNotNull(), F.struct(F.col("_time").alias("at"), F.col("_found").alias("found"))))
    ranged = materialize(times.repartitionByRange(*by, "_time")).withColumn("_part", F.spark_partition_id())
    # The last hit of a key in a partition is its largest, since hits are (time, ...) structs.
    ends = ranged.groupBy(*by, "_part").agg(F.max("_hit").alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(*by, "_part", F.max("_end").over(earlier).alias("_handed"))
    inside = Window.partitionBy(*by, "_part").orderBy("_time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = ranged.withColumn("_here", F.last("_hit", ignorenulls=True).over(inside)).filter("_asked")
    answers = null_safe_join(here.select(*by, "_part", "_time", "_here"), handed, [*by, "_part"], "left").select(
        *by, F.col("_time").alias(left_time), F.coalesce("_here", "_handed").alias("_answer"))
    out = null_safe_join(left, answers, [*by, left_time], "left")
    return out.select(*[F.col(f"`{c}`") for c in left.columns], F.col("_answer.at").alias(right_time),
                      *[F.col(f"_answer.found.{c}").alias(c) for c in carry])
