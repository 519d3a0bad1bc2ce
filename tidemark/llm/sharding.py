"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Shard sizes are fixed first (at most one row apart).  The matrix says how many
rows each input partition sends to each shard; its rows are drawn one after the
other from the multivariate hypergeometric law of the places still free, which
is the law of a uniform shuffle.  Each partition then deals its rows out in a
random order of its own (permute), rows go to their shard (exchange), and a
second keyed permutation of the shard's places gives each row its slot: a
Feistel bijection, so places stay gapless and no task holds a whole shard.

The driver holds one count per partition and shard, nothing per row.  The input
must come back in the same partitions when it is read twice or after a lost
task: a checkpoint, or a file scan, whose splits are pinned for the session.  Nulls, ties and repeated rows do not matter;
rows are dealt by position alone, so equal texts are spread like any others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.frames import pin_splits, small_batches

BLOCK_ROWS = 2048
#: The library's generator takes populations below this; larger ones are drawn by distinct places.
LIBRARY_LIMIT = 10**9 - 1


def draw_row(rng: np.random.Generator, free: np.ndarray, n: int) -> np.ndarray:
    """How ``n`` rows fall on shards with ``free`` places: multivariate hypergeometric."""
    if free.sum() <= LIBRARY_LIMIT:
        return rng.multivariate_hypergeometric(free, n, method="marginals")
    places = rng.choice(int(free.sum()), n, replace=False, shuffle=False)
    return np.bincount(np.searchsorted(np.cumsum(free), places, side="right"), minlength=len(free))


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each partition to each shard, with shard sizes at most one apart."""
    total = sum(counts)
    free = np.full(shards, total // shards, np.int64)
    free[: total % shards] += 1
    rng = np.random.default_rng([seed, 0])
    out = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        out[p] = draw_row(rng, free, n)
        free -= out[p]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..size-1: Feistel rounds on the next even number of bits, walked until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([key, 1]).integers(1, 1 << 63, 6, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return left << np.uint64(half) | right

    x = once(index.astype(np.uint64))
    while (outside := x >= size).any():
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def shard(df: DataFrame, shards: int = 16, seed: int = 11, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """The rows of ``df`` with their shard and slot, exchanged so that each task holds blocks of one shard's slots in order.

    Input columns named like the new ones give way."""
    spark = df.sparkSession
    pin_splits(spark)
    base = df.drop(shard_col, slot_col)
    found = {r[0]: r[1] for r in base.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()}
    counts = [found.get(p, 0) for p in range(max(found, default=-1) + 1)]
    matrix = communication_matrix(counts, shards, seed)
    first = np.cumsum(matrix, axis=0) - matrix
    sizes = matrix.sum(axis=0)
    names = [f.name for f in base.schema.fields]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, at, order = TaskContext.get().partitionId(), 0, None
        for b in batches:
            if not b.num_rows:
                continue
            if order is None:
                order = np.repeat(np.arange(shards, dtype=np.int32), matrix[p])
                np.random.default_rng([seed, 2, p]).shuffle(order)
                taken = first[p].copy()
            mine = order[at : at + b.num_rows]
            at += b.num_rows
            if len(mine) != b.num_rows:
                raise RuntimeError("the input changed between two reads; checkpoint it first")
            slots = np.empty(len(mine), np.int64)
            for s in range(shards):
                here = np.flatnonzero(mine == s)
                if len(here):
                    slots[here] = permuted(taken[s] + np.arange(len(here)), int(sizes[s]), seed * shards + s)
                    taken[s] += len(here)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(mine, pa.int64()), pa.array(slots)], [*names, shard_col, slot_col])

    small_batches(spark)
    schema = StructType([*base.schema.fields, StructField(shard_col, LongType()), StructField(slot_col, LongType())])
    dealt = base.mapInArrow(deal, schema).withColumn(shard_col, F.col(shard_col).cast("int"))
    return dealt.repartition(shard_col, F.floor(F.col(slot_col) / BLOCK_ROWS)).sortWithinPartitions(shard_col, slot_col)
