"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, once per curve and each time with
another projection and shift, and placed on a Hilbert curve.  Spark range-partitions
every curve by key and id, so a partition is a block of neighbouring rows, however
many share a key.  A query looks into the blocks around its own key on every curve;
the candidates are merged and ranked by their exact inner product.

That gives the query a lower bound for its last neighbour.  For the rest there is
an exact way: a block whose centre and radius prove that no row of it reaches the
bound is left out, any other block of the first curve is read too.  So results are
those of a full search at every size; how much is read depends on how well the
vectors cluster (vectors without structure need nearly all blocks).

The driver and the tasks hold one centre, radius and key range per part of ``PART``
rows and curve.  ``MAX_BLOCKS`` bounds the partitions of a curve, not these parts: what
is held grows with the table, about one part in ``PART`` of its rows per curve.  Null, empty and zero vectors and vectors with null or non-finite
components take no part; vectors of another length than the most frequent one
neither.  Repeated rows are candidates each, told apart by a row number that is written
with the index, and queries each; ties go to the smaller id.  Rows with a null id take
no part.  A repeated task must meet the same rows in the same order (a file scan or a
checkpoint), or row numbers could change.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.embedding_dedup import usable
from tidemark.llm.frames import map_batches, small_batches
from tidemark.session import materialize

CURVES, DIMENSIONS, BITS = 3, 6, 10
BLOCK_ROWS, MAX_BLOCKS, PART, WINDOW = 4096, 4096, 4096, 1
QUERIES = 1024


def hilbert_keys(cell: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve through a grid of 2**bits per dimension.

    From the highest bit down, each dimension's bit decides a reflection or an exchange of the lower bits with the
    first dimension; the Gray code of what is left, read across the dimensions, is the position."""
    x = cell.astype(np.int64).T.copy()
    d = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(d):
            reflect = (x[i] & bit) > 0
            swap = np.where(reflect, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(reflect, low, swap)
            if i:
                x[i] ^= swap
        bit >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) > 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(vectors: np.ndarray, curve: int, seed: int) -> np.ndarray:
    """The key of each vector's direction: projected, shifted by a random part of the cube, cut to the grid."""
    d = vectors.shape[1]
    rng = np.random.default_rng([seed, curve, d])
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    y = unit @ rng.normal(size=(d, DIMENSIONS))  # about standard normal: the cube from -6 to 6 holds it
    place = (y + 6) / 12 + rng.uniform(-0.1, 0.1, DIMENSIONS)
    return hilbert_keys(np.clip(place * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first component to the last."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


@dataclass
class Blocks:
    """Key ranges, centres and radii of one curve's blocks, in the order of the curve."""

    block: np.ndarray
    low: np.ndarray
    centre: np.ndarray
    radius: np.ndarray

    def window(self, keys: np.ndarray) -> np.ndarray:
        """Query x block: whether the block is its own or a neighbour of it."""
        own = np.maximum(np.searchsorted(self.low, keys, side="right") - 1, 0)
        first = np.maximum(np.searchsorted(self.low, keys, side="left") - 1, 0)  # equal keys may begin blocks earlier
        at = np.arange(len(self.block))
        return (at >= np.minimum(first, own)[:, None] - WINDOW) & (at <= own[:, None] + WINDOW)

    def reach(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Query x block: whether some row of the block could have an inner product of ``bound`` or more."""
        norm = np.sqrt((q * q).sum(axis=1))
        most = q @ self.centre.T + norm[:, None] * self.radius
        return most * (1 + 1e-9) + 1e-9 * (1 + np.abs(bound[:, None])) >= bound[:, None]


def matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64)


def index(rows: DataFrame, blocks: int, seed: int) -> DataFrame:
    """``rows`` (id, v, row) on every curve, range-partitioned: one row per block part, with ids, row numbers, vectors, keys, centre and radius."""

    def place(b: pa.RecordBatch) -> pa.Table:
        flat = b.column(1).flatten().to_numpy()
        x = flat.reshape(b.num_rows, -1)
        vectors = pa.array([r.tobytes() for r in x], pa.binary())
        return pa.concat_tables([pa.table({"curve": pa.array([c] * b.num_rows, pa.int32()), "key": pa.array(curve_keys(x, c, seed)), "id": b.column(0), "row": b.column(2), "v": vectors}) for c in range(CURVES)])

    keyed = map_batches(rows, place, "curve int, key bigint, id bigint, row bigint, v binary")
    ranged = keyed.repartitionByRange(max(1, blocks * CURVES), "curve", "key", "id", "row").sortWithinPartitions("curve", "key", "id", "row")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held = TaskContext.get().partitionId(), 0, []

        def emit(t: pa.Table) -> pa.RecordBatch:
            x = matrix(b"".join(t["v"].to_pylist())).reshape(t.num_rows, -1)
            centre, key = x.mean(axis=0), t["key"].to_numpy()
            radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
            values = ([t["curve"][0].as_py()], [part << 32 | n], [int(key[0])], [t["id"].to_numpy().tobytes()], [t["row"].to_numpy().tobytes()], [x.tobytes()], [centre.tobytes()], [radius])
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64()))], ["curve", "block", "low", "ids", "rows", "vectors", "centre", "radius"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([*held, b])
            while True:
                curve = t["curve"].to_numpy()
                same = int((curve == curve[0]).sum())
                if same == t.num_rows and same < PART:
                    break
                yield emit(t.slice(0, min(same, PART)))
                n, t = n + 1, t.slice(min(same, PART))
                if not t.num_rows:
                    break
            held = t.combine_chunks().to_batches()
        if held and sum(h.num_rows for h in held):
            yield emit(pa.Table.from_batches(held))

    small_batches(rows.sparkSession, 1024)
    return ranged.mapInArrow(gather, "curve int, block bigint, low bigint, ids binary, rows binary, vectors binary, centre binary, radius double")


def summaries(indexed: DataFrame) -> list[Blocks]:
    """One row per part and curve reaches the driver: about rows / ``PART`` for each curve, without a bound of its own."""
    got = indexed.select("curve", "block", "low", "centre", "radius").toArrow()
    curve, block, low = (got[c].to_numpy() for c in ("curve", "block", "low"))
    centre = np.stack([matrix(c) for c in got["centre"].to_pylist()]) if got.num_rows else np.zeros((0, 1))
    out = []
    for c in range(CURVES):
        mine = np.flatnonzero(curve == c)
        mine = mine[np.lexsort((block[mine], low[mine]))]
        out.append(Blocks(block[mine], low[mine], centre[mine], got["radius"].to_numpy()[mine]))
    return out


def ask(queries: DataFrame, indexed: DataFrame, by_curve: list[Blocks], k: int, seed: int, again: bool) -> DataFrame:
    """(n, query_id, times, row, vec_id, score): per query and block read, at most the ``k`` best.  ``queries``: n, id, times, v
    and, if ``again``, the bound; then the blocks of the first curve that reach it and were not in its window."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, ids, times, bound = (b.column(c).to_numpy() for c in ("n", "id", "times", "bound"))
            x = matrix(b"".join(b.column("v").to_pylist())).reshape(b.num_rows, -1)
            rows = []
            for c, blocks in enumerate(by_curve[:1] if again else by_curve):
                wanted = blocks.window(curve_keys(x, c, seed))
                if again:
                    wanted = ~wanted & blocks.reach(x, bound)
                for j in np.flatnonzero(wanted.any(axis=0)):
                    q = np.flatnonzero(wanted[:, j])
                    rows.append((int(blocks.block[j]), n[q].tobytes(), ids[q].tobytes(), times[q].tobytes(), x[q].tobytes(), bound[q].tobytes()))
            for lo in range(0, len(rows), 16):
                columns = list(zip(*rows[lo : lo + 16]))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["block", "ns", "q_ids", "times", "q", "bound"])

    def rank(b: pa.RecordBatch) -> pa.Table:
        out = []
        for *numbers, q, bound, ids, rows, vectors in zip(*[c.to_pylist() for c in b.columns]):
            n, q_ids, times, ids, rows = (np.frombuffer(data, np.int64) for data in (*numbers, ids, rows))
            bound = matrix(bound)
            q, x = matrix(q).reshape(len(q_ids), -1), matrix(vectors).reshape(len(ids), -1)
            score = q @ x.T
            score[q_ids[:, None] == ids] = -np.inf  # a query is no candidate of its own
            least = np.partition(score, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q_ids), -np.inf)
            least = np.maximum(least, bound)
            slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
            i, j = np.nonzero((score >= (least - slack)[:, None]) & np.isfinite(score))
            exact = products(q[i], x[j])
            # ties at the edge: the k best by score, then id, then row
            order = np.lexsort((rows[j], ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
            i, j, exact = i[place < k], j[place < k], exact[place < k]
            out.append(pa.table({"n": n[i], "query_id": q_ids[i], "times": times[i], "row": rows[j], "vec_id": ids[j], "score": exact}))
        return pa.concat_tables(out)

    small_batches(queries.sparkSession, QUERIES)
    routed = materialize(queries.select("n", "id", "times", "v", "bound").mapInArrow(route, "block bigint, ns binary, q_ids binary, times binary, q binary, bound binary"))
    small_batches(queries.sparkSession, 2)  # each joined row holds a block
    joined = routed.join(indexed.select("block", "ids", "rows", "vectors"), "block").select("ns", "q_ids", "times", "q", "bound", "ids", "rows", "vectors")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from rank(b).to_batches()

    out = materialize(joined.mapInArrow(ranked, "n bigint, query_id bigint, times bigint, row bigint, vec_id bigint, score double"))
    small_batches(queries.sparkSession)
    return out


def best(found: DataFrame, k: int, by: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 29) -> DataFrame:
    """The ``k`` rows of the largest inner product for every query row: query_id, rank, vec_id, score."""
    rows = df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d, n = (sizes["d"], sizes["count"]) if sizes else (1, 0)
    rows = rows.where(F.size("v") == d)
    blocks = min(MAX_BLOCKS, max(1, -(-n // BLOCK_ROWS)))
    indexed = materialize(index(rows.select("id", "v", F.monotonically_increasing_id().alias("row")), blocks, seed))
    by_curve = summaries(indexed)

    def pack(b: pa.RecordBatch) -> pa.RecordBatch:
        x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(curve_keys(x, 0, seed))], ["id", "v", "key"])

    queries = map_batches(rows.where("q").select("id", "v"), pack, "id bigint, v binary, key bigint").groupBy("id", "v", "key").agg(F.count("*").alias("times"))
    queries = materialize(queries.repartitionByRange("key", "id").sortWithinPartitions("key", "id").withColumn("n", F.monotonically_increasing_id()))
    near = ask(queries.withColumn("bound", F.lit(float("-inf"))), indexed, by_curve, k, seed, again=False)
    near = best(near.distinct(), k, "n")  # a row is found on several curves
    bound = near.where(F.col("rank") == k).select("n", F.col("score").alias("least"))
    asked = queries.join(bound, "n", "left").withColumn("bound", F.coalesce("least", F.lit(float("-inf"))))
    rest = ask(asked, indexed, by_curve, k, seed, again=True)
    # a query row that is there several times has every neighbour as often
    found = near.drop("rank").union(rest).distinct().withColumn("again", F.explode(F.array_repeat(F.lit(0), F.least("times", F.lit(k)).cast("int"))))
    return best(found, k, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
