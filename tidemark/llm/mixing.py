"""Mixing sources to target weights by capped water-filling.

Every source has a weight and may be repeated ``max_epochs`` times at most.
Targets share the words of all sources in proportion to the weights; a source
whose share exceeds its cap stops there and what it leaves is shared out again.
In the order of cap / weight the capped sources are a prefix, so two running
sums over one row per source give the level at which all targets fit.

A source is then taken whole as often as its target allows, and the rest of
the target is filled with documents in the order of a seeded hash, up to the
document whose end is nearest.  Documents are counted per hash bucket first,
so only the one bucket per source that holds the cut is ever ordered; a source
with a third of all rows needs no large task.  Only DataFrame functions are used.

Null or empty texts have size 0 and are never taken.  A null source is a source
of its own, last in order.  Rows with the same id and text share their hash and
are taken or left together.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
HASH_BITS = 52
#: A table of sources is broadcast up to so many bytes of names and so many rows, and joined by a shuffle beyond.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 4 << 20


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_hash(seed: int, id_col: str, text_col: str) -> F.Column:
    """52 bits of a hash of seed, id and text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def water_fill(sources: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``); ``weights`` repeat along the sources by code point, null last."""
    place = Window.orderBy(F.col("source").isNull(), "source")
    level = Window.orderBy("ratio", "place")
    before, everything = level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    cap = F.col("source_size") * max_epochs
    out = (
        sources.withColumn("place", F.row_number().over(place))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("left", F.col("words") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weights_left", F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("left") / F.col("weights_left") >= F.col("ratio"))
        .withColumn("capped_words", F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(everything))
        .withColumn("open_weights", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything))
    )
    shared = (F.col("words") - F.col("capped_words")) / F.col("open_weights") * F.col("weight")
    return out.select("source", "source_size", F.when(F.col("capped"), cap.cast("double")).otherwise(shared).alias("target"))


def plan(rows: DataFrame, weights: Sequence[float], max_epochs: int, bits: int) -> DataFrame:
    """One row per source: target, whole repetitions and the hash below which one more is taken.  ``rows``: source, size, u."""
    bucket = F.shiftright("u", HASH_BITS - bits)
    fine = materialize(rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    targets = water_fill(fine.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = materialize(targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))

    up_to = Window.partitionBy("source").orderBy("bucket")
    at = (
        fine.withColumn("end", F.sum("words").over(up_to)).withColumnRenamed("source", "of")
        .join(targets, F.col("of").eqNullSafe(F.col("source")))
        .where((F.col("end") - F.col("words") <= F.col("rest")) & (F.col("end") > F.col("rest")))
        .select("source", "bucket", (F.col("rest") - (F.col("end") - F.col("words"))).alias("rest_here"))
    )
    here = rows.select(F.col("source").alias("of"), "size", "u", bucket.alias("b")).join(F.broadcast(at) if small(targets) else at, F.col("of").eqNullSafe(F.col("source")) & (F.col("b") == F.col("bucket")))
    same = here.groupBy("source", "bucket", "rest_here", "u").agg(F.sum("size").alias("words"))
    run = F.sum("words").over(Window.partitionBy("source").orderBy("u"))
    cut = (
        same.withColumn("end", run)
        .groupBy("source", "bucket")
        .agg(F.max(F.when(F.col("end") - F.col("words") / 2 <= F.col("rest_here"), F.col("u") + 1)).alias("cut"))
        .select(F.col("source").alias("of"), F.coalesce("cut", F.shiftleft("bucket", HASH_BITS - bits)).alias("cut"))
    )
    return targets.join(cut, F.col("of").eqNullSafe(F.col("source")), "left").select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))


def small(sources: DataFrame) -> bool:
    n = sources.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("source"), F.lit(0)))).first()
    return n[0] <= BROADCAST_ROWS and (n[1] or 0) <= BROADCAST_BYTES


def mix(df: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", out: str = "mix") -> DataFrame:
    """The rows of ``df`` with a struct ``out``: size, source_size, target, taken (words, repeats counted) and repeats (copies of the row).

    An input column named like ``out`` gives way.  Reruns give the same mix."""
    base = df.drop(out)
    size, u = n_words(F.col(text_col)), seeded_hash(seed, id_col, text_col)
    rows = materialize(base.select(F.col(source_col).alias("source"), size.alias("size"), u.alias("u")))
    bits = max(1, min(30, rows.count().bit_length() // 2))
    chosen = materialize(plan(rows, weights, max_epochs, bits))
    packed = chosen.select(F.col("source").alias("_mix_source"), F.struct(*chosen.columns).alias("_mix_plan"))
    joined = base.join(F.broadcast(packed) if small(chosen) else packed, F.col(source_col).eqNullSafe(F.col("_mix_source")))
    p = F.col("_mix_plan")
    repeats = F.when(size > 0, p["whole"] + (u < p["cut"]).cast("int")).otherwise(0)
    made = F.struct(size.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), repeats.alias("repeats"))
    whole = joined.withColumn("_mix_made", made)
    m = F.col("_mix_made")
    return whole.select(*[F.col(f"`{c}`") for c in base.columns], F.struct(m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["repeats"]).cast("bigint").alias("taken"), m["repeats"].alias("repeats")).alias(out))


def repeated(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """The mix itself: each row as many times as it is taken, without ``out``."""
    return mixed.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col(out)["repeats"]))).drop("_mix_copy", out)
