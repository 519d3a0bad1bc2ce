"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return _distinct(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself under the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(hung.union(least.select("a", F.col("m").alias("b"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns ``a`` and ``b`` without nulls.  Returns ``node`` and ``root`` (the smallest node of its
    component) for every node that has a link and isn't its own root.

    Nothing per node reaches the driver; each round is checkpointed and ends with one checksum.  Rounds grow with the
    logarithm of a component's size."""
    now, last = materialize(_distinct(edges.select("a", "b"))), None
    while True:
        now = materialize(_small_star(_large_star(now)))
        check = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = check
