"""Near-duplicate vectors by E8 lattice hashing.

Unit vectors are projected to eight dimensions per table, scaled, shifted and
decoded to the nearest point of the E8 lattice; that point is the vector's cell.
Each vector also probes the neighbouring cells nearest to it (the 240 shortest
lattice vectors lead to them).  Vectors that meet in a cell are compared by
their exact cosine in double precision.

A pair may meet in several cells and must count once.  Every vector carries the
codes of all its cells, so any cell can tell whether it is the first meeting place
of a pair, and only there the pair counts.  So no pair is ever written out: a task
returns a number of links and one local root per vector.  Cells with more than
``BLOCK`` vectors are compared block by block, each pair of blocks a task of its
own.  Exact copies are one vector with a multiplicity.

Null, empty and zero vectors and vectors with null or non-finite components
link with nothing.  Vectors of different length never link.  Repeated rows are
copies.  A null id takes part, but is never the smallest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.frames import map_batches, small_batches
from tidemark.session import materialize

TABLES, PROBES, SCALE = 10, 3, 2.2
BLOCK = 2048


@lru_cache(1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or all halves with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(out)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: round, and where the sum is odd move the worst coordinate the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    off = x[odd] - r[odd]
    worst = np.abs(off).argmax(axis=1)
    r[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, which is the even-sum points and the same moved by a half."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    return np.where(((x - a) ** 2).sum(axis=1, keepdims=True) <= ((x - b) ** 2).sum(axis=1, keepdims=True), a, b)


def code(points: np.ndarray, salt: int) -> np.ndarray:
    """32 bits of a hash of lattice points."""
    h = np.full(points.shape[:-1], salt, np.uint64)
    for k in range(8):
        h = (h ^ (2 * points[..., k]).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(32)).astype(np.uint32)


def codes(unit: np.ndarray, seed: int) -> np.ndarray:
    """Per vector and table: the code of its cell, then of the cells it probes."""
    n, d = unit.shape
    out = np.empty((n, TABLES, 1 + PROBES), np.uint32)
    rng = np.random.default_rng([seed, d])
    for t in range(TABLES):
        x = unit @ (rng.normal(size=(d, 8)) * (SCALE / np.sqrt(8))) + rng.uniform(size=8)
        cell = decode(x)
        near = np.argpartition(-((x - cell) @ shortest().T), PROBES, axis=1)[:, :PROBES]
        out[:, t, 0] = code(cell, 1000 * d + t)
        out[:, t, 1:] = code(cell[:, None] + shortest()[near], 1000 * d + t)
    return out


def meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pair x table: whether one has its cell where the other has its cell or probes."""
    return (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)


def usable(vector_col: str) -> F.Column:
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


class Cell:
    """Rows that stand in one cell (or one pair of its blocks), ordered by key, and the links first met there."""

    def __init__(self, table: int, key: np.ndarray, home: np.ndarray, left: np.ndarray, right: np.ndarray, unit: np.ndarray, code_of: np.ndarray, weight: np.ndarray):
        self.table, self.key, self.home, self.left, self.right, self.unit, self.code, self.weight = table, key, home, left, right, unit, code_of, weight

    def links(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(self.left & self.home), np.flatnonzero(self.right)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(left), 256):
            part = left[at : at + 256]
            i, j = np.nonzero(self.unit[part] @ self.unit[right].T >= least)
            i, j = part[i], right[j]
            for lo in range(0, len(i), 1 << 15):
                a, b = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
                a, b = a[self.key[a] != self.key[b]], b[self.key[a] != self.key[b]]
                if not len(a):
                    continue
                ca, cb = self.code[a], self.code[b]
                first = ~meets(ca[:, : self.table], cb[:, : self.table]).any(axis=1) if self.table else np.ones(len(a), bool)
                both = self.home[b] | (cb[:, self.table, :1] == ca[:, self.table, 1:]).any(axis=1)
                first &= ~both | (self.key[a] < self.key[b])
                found.append((a[first], b[first]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def result(self, least: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        a, b = self.links(least)
        if not len(a):
            return []
        n = np.bincount(a, self.weight[b], len(self.key)) + np.bincount(b, self.weight[a], len(self.key))
        own, back = np.unique(self.key, return_inverse=True)  # a row may stand on both sides
        root = local_roots(len(own), back[a], back[b])
        sums = np.bincount(back, n, len(own)).astype(np.int64)
        seen = np.flatnonzero(sums > 0)
        return [(own[seen], sums[seen], own[root[seen]])]


def link(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, seed: int = 17) -> DataFrame:
    """One row per row of ``df``: id, ``n_links``, ``component_id`` and ``kept`` (it is the smallest of its component)."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.when(usable(vector_col), F.col(vector_col).cast("array<double>")).alias("v"))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least_id"), F.count("*").alias("copies"))
    # keys are drawn once and written, so that every later reading has the same
    classes = materialize(classes.withColumn("key", F.monotonically_increasing_id()))

    def sign(b: pa.RecordBatch) -> pa.Table:
        vectors = b.column(1)
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy()
        ends = np.cumsum(sizes)
        out = np.empty((b.num_rows, TABLES * (1 + PROBES)), np.uint32)
        units: list[bytes] = [b""] * b.num_rows
        for d in np.unique(sizes):
            mine = np.flatnonzero(sizes == d)
            x = np.stack([flat[ends[i] - d : ends[i]] for i in mine])
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            out[mine] = codes(x, seed).reshape(len(mine), -1)
            for i, u in zip(mine, x):
                units[i] = u.tobytes()
        return pa.table({"key": b.column(0), "copies": b.column(2), "unit": pa.array(units, pa.binary()), "codes": pa.array([c.tobytes() for c in out], pa.binary()), "cells": pa.array(list(out.astype(np.int64)), pa.list_(pa.int64()))})

    signed = materialize(map_batches(classes.select("key", "v", "copies"), sign, "key bigint, copies bigint, unit binary, codes binary, cells array<bigint>"))
    stands = signed.select("key", F.posexplode("cells").alias("place", "code")).select(
        "key", F.expr(f"cast(place / {1 + PROBES} as int)").alias("tab"), (F.col("place") % (1 + PROBES) == 0).alias("home"), "code"
    )
    full = stands.groupBy("tab", "code").agg(F.count("*").alias("n"), F.max("home").alias("lived")).where("n > 1 AND lived").select("tab", "code", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = stands.join(full, ["tab", "code"]).withColumn("own", own)
    # a row stands left in its own block against every block, and right in every block against its own
    together = placed.where("blocks = 1").select("tab", "code", "key", "home", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(True).alias("l"), F.lit(True).alias("r"))
    split = placed.where("blocks > 1").withColumn("o", other)
    lefts = split.where("home").select("tab", "code", "key", "home", F.col("own").alias("x"), F.col("o").alias("y"), F.lit(True).alias("l"), F.lit(False).alias("r"))
    rights = split.select("tab", "code", "key", "home", F.col("o").alias("x"), F.col("own").alias("y"), F.lit(False).alias("l"), F.lit(True).alias("r"))
    work = together.union(lefts).union(rights).join(signed.select("key", "copies", "unit", "codes"), "key")
    names = ["tab", "code", "x", "y", "key", "home", "l", "r", "copies", "unit", "codes"]
    work = work.select(*names).repartition("tab", "code", "x", "y").sortWithinPartitions("tab", "code", "x", "y", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(t: pa.Table) -> pa.RecordBatch:
            found = [r for c in cells(t) for r in c.result(least)]
            k, n, r = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(r, pa.int64())], ["key", "n", "root"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([*held, b])
            starts = cell_starts(t)
            last = int(starts[-1])
            if last and t.num_rows >= 1024:
                yield done(t.slice(0, last))
                held = t.slice(last).combine_chunks().to_batches()
            else:
                held = t.to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    small_batches(spark, 2048)
    met = materialize(work.mapInArrow(compare, "key bigint, n bigint, root bigint"))
    small_batches(spark)
    counts = met.groupBy("key").agg(F.sum("n").alias("n"))
    roots = connected_components(met.select(F.col("key").alias("a"), F.col("root").alias("b")))
    of = classes.join(counts, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least_of = of.groupBy("root").agg(F.min("least_id").alias("component"))
    of = of.join(least_of, "root").select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
    out = rows.join(of, "v", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def cell_starts(t: pa.Table) -> np.ndarray:
    change = np.ones(t.num_rows, bool)
    change[1:] = False
    for name in ("tab", "code", "x", "y"):
        c = t.column(name).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def cells(t: pa.Table) -> Iterator[Cell]:
    starts = cell_starts(t)
    ends = np.append(starts[1:], t.num_rows)
    column = {n: t.column(n).to_numpy(zero_copy_only=False) for n in ("tab", "key", "home", "l", "r", "copies")}
    units, packed = t.column("unit").to_pylist(), t.column("codes").to_pylist()
    for s, e in zip(starts, ends):
        sizes = {len(u) for u in units[s:e]}
        for size in sizes:  # vectors of one length; others share a cell only by a hash collision
            at = np.array([i for i in range(s, e) if len(units[i]) == size])
            unit = np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), -1)
            code_of = np.frombuffer(b"".join(packed[i] for i in at), np.uint32).reshape(len(at), TABLES, 1 + PROBES)
            yield Cell(int(column["tab"][s]), column["key"][at], column["home"][at], column["l"][at], column["r"][at], unit, code_of, column["copies"][at])
