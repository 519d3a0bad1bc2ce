"""Hard negatives by BOND, a vertical scan of vectors with shrinking bounds.

Components become whole numbers, floor(``scale`` * x), so scores (inner products) are exact.  Rows are
packed into blocks that hold one array per dimension, with the least and greatest value of each.

An anchor reads a block dimension by dimension, those with its largest magnitudes first, and adds up
partial scores of the candidates in its bitmap.  What the dimensions still unread can add lies between
two sums of the block's least and greatest values, so every candidate has a lower and an upper bound, and after
each ``STEP`` dimensions the bitmap loses the candidates that can't matter any more:

1. Positives, the ``positives`` rows of the same label that score highest: a candidate goes when its upper bound is
   below the lower bounds of enough others (of this block, or exact scores of earlier blocks of the task).
2. Negatives, for every positive the first ``negatives`` rows of another label whose score lies between
   ``low`` and ``high`` percent of the positive's: a candidate goes when its bounds meet none of the anchor's windows, where
   a window's lower end rises to what enough candidates that surely lie in it reach.  What is left at the end
   has exact scores, and each window takes its best.

Anchors travel in groups to buckets of blocks (an equal join on the bucket), so a task holds one group and one block at a time
and no candidate pair is ever a row.  A block's best rows per anchor or window are merged by a row number that Spark cuts
down before the shuffle as well.  Labels don't decide where rows go, so a hot label is spread like any other.

Rows with a null id, label or vector or with a null or non-finite component take no part; empty vectors neither.  Vectors of
different length never meet.  Candidates of an anchor are rows with another id; rows repeated word for word are candidates each
and anchors once.  An anchor without positives or without rows in a window has no output.  Ties go to the smaller id.
Components are held within +-2^31 / sqrt(length), so that scores stay within 64 bits.  Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches
from tidemark.session import materialize

BLOCK, GROUP, STEP = 2048, 256, 8
BLOCKS_PER_BUCKET = 4


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label`` and whole ``v`` of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = F.floor(F.lit(2.0**31) / F.sqrt(F.size(v))) - 1
    whole = F.transform(v, lambda x: F.greatest(F.least(F.floor(x * scale), most), -most).cast("int"))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(vector_col) > 0))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"), whole.alias("v"))


def packed(rows: DataFrame, size: int, extra: str = "") -> DataFrame:
    """Rows (``id``, ``label``, ``v`` and the columns of ``extra``) in blocks of ``size``: lists, and the vectors dimension after dimension."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    names = ["id", "label", *extra.split()]
    schema = "d int, n int, " + ", ".join(f"{n} array<{kind[n]}>" for n in names) + ", v binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}

        def block(t: pa.Table, d: int) -> pa.RecordBatch:
            t = t.combine_chunks()
            x = flat(t.column("v")).reshape(-1, d)
            lists = [pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), one(t.column(n))) for n in names]
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([t.num_rows], pa.int32()), *lists, pa.array([np.ascontiguousarray(x.T).astype("<i4").tobytes()], pa.binary())], names=["d", "n", *names, "v"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            lengths = pc.list_value_length(t.column("v")).to_numpy()
            for d in np.unique(lengths).tolist():
                held.setdefault(d, []).append(t.filter(pa.array(lengths == d)))
                while sum(x.num_rows for x in held[d]) >= size:
                    whole = pa.concat_tables(held[d])
                    yield block(whole.slice(0, size), d)
                    held[d] = [whole.slice(size)]
        for d, parts in held.items():
            whole = pa.concat_tables(parts)
            if whole.num_rows:
                yield block(whole, d)

    return rows.select(*names, "v").mapInArrow(pack, schema)


def one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return one(column).flatten().to_numpy(zero_copy_only=False)


class Block:
    """Vectors of one length, one array per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: bytes, d: int):
        self.ids, self.labels, self.having = ids, labels, {}
        whole = np.frombuffer(v, "<i4").reshape(d, -1)
        self.least, self.most = whole.min(axis=1).astype(np.int64), whole.max(axis=1).astype(np.int64)
        self.largest = max(-int(self.least.min()), int(self.most.max()), 1)
        self.v = whole.astype(np.int64)

    def labelled(self, label: str) -> np.ndarray:
        if label not in self.having:
            self.having[label] = np.array(self.labels == label, bool)
        return self.having[label]


def scan(block: Block, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``bitmap`` that ``keep(lower, upper)`` leaves, and their exact scores."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = anchor * block.least, anchor * block.most
    # what the dimensions from each step on can add at least and at most
    low = np.append(np.cumsum(np.minimum(*ends)[order][::-1])[::-1], 0)
    high = np.append(np.cumsum(np.maximum(*ends)[order][::-1])[::-1], 0)
    rows, part = np.flatnonzero(bitmap), None
    part = np.zeros(len(rows), np.int64)
    for at in range(0, len(order), STEP):
        left = keep(part + low[at], part + high[at])
        if not left.all():
            rows, part = rows[left], part[left]
        if not len(rows):
            break
        for k in order[at : at + STEP]:
            part += anchor[k] * block.v[k][rows]
    return rows, part


def kth(values: np.ndarray, k: int) -> int | None:
    """The k-th largest value, if there are as many."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by id."""
    if len(rows) > k:
        at = np.flatnonzero(scores >= kth(scores, k))
        return at[np.lexsort((ids[rows[at]], -scores[at]))[:k]]
    return np.lexsort((ids[rows], -scores))


def positives_in(block: Block, anchor: np.ndarray, bitmap: np.ndarray, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows; ``least`` is a score that k rows elsewhere reach."""
    bound = [least]

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if (here := kth(lower, k)) is not None and (bound[0] is None or here > bound[0]):
            bound[0] = here
        return upper >= bound[0] if bound[0] is not None else np.ones(len(upper), bool)

    rows, scores = scan(block, anchor, bitmap, keep)
    at = best(rows, scores, block.ids, k)
    return rows[at], scores[at]


def negatives_in(block: Block, anchor: np.ndarray, bitmap: np.ndarray, windows: list[list[int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (lowest and highest score) its k best rows.  The lower ends of ``windows`` rise to scores that k rows reach."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for w in windows:
            sure = lower[(lower >= w[0]) & (upper <= w[1])]
            if (here := kth(sure, k)) is not None:
                w[0] = max(w[0], here)
            out |= (upper >= w[0]) & (lower <= w[1])
        return out

    rows, scores = scan(block, anchor, bitmap, keep)
    out = []
    for w in windows:
        inside = np.flatnonzero((scores >= w[0]) & (scores <= w[1]))
        at = inside[best(rows[inside], scores[inside], block.ids, k)]
        if (here := kth(scores[at], k)) is not None:
            w[0] = max(w[0], here)
        out.append((rows[at], scores[at]))
    return out


def meeting(groups: DataFrame, blocks: DataFrame, buckets: int) -> DataFrame:
    """Every group beside every block of its length, group after group inside a bucket."""
    left = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).select("bucket", "d", *[F.col(c).alias(f"a_{c}") for c in groups.columns if c != "d"])
    on = ["bucket", "d"]
    return left.repartition(2 * buckets, *on).join(blocks.repartition(2 * buckets, *on).hint("shuffle_merge"), on).drop("bucket")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows with their lists as arrays."""
    for b in batches:
        for k in range(b.num_rows):
            row = {}
            for name, column in zip(b.schema.names, b.columns):
                cell = column[k]
                row[name] = cell.values if pa.types.is_list(column.type) else cell.as_py()
            yield row


def block_of(row: dict) -> Block:
    return Block(row["id"].to_numpy(), row["label"].to_numpy(zero_copy_only=False), row["v"], row["d"])


def mine(
    df: DataFrame, anchors: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score`` for the rows of ``df`` where
    ``anchors`` holds (a condition on the id column)."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    small_batches(spark, 2048)
    rows = usable(df, id_col, vector_col, label_col, scale)
    blocks = materialize(packed(rows, BLOCK).withColumn("number", F.monotonically_increasing_id()))
    buckets = max(1, -(-blocks.count() // BLOCKS_PER_BUCKET))
    # some buckets get more blocks than others; both sides meet on the bucket alone
    blocks = blocks.select("id", "label", "v", "d", F.pmod(F.xxhash64("number"), F.lit(buckets)).cast("int").alias("bucket"))
    chosen = usable(df.where(anchors), id_col, vector_col, label_col, scale).distinct()
    chosen = materialize(chosen.withColumn("anchor", F.monotonically_increasing_id()))
    groups = materialize(packed(chosen, GROUP, "anchor"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: tuple[int, dict[int, np.ndarray]] = (-1, {})  # of the group met last: the scores of its anchors' best rows so far
        for row in rows_of(batches):
            block, keys = block_of(row), row["a_anchor"].to_numpy()
            if keys[0] != reached[0]:
                reached = (keys[0], {})
            vectors = np.frombuffer(row["a_v"], "<i4").reshape(row["d"], -1).T.astype(np.int64)
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for key, own, label, v in zip(keys, row["a_id"].to_numpy(), row["a_label"].to_pylist(), vectors):
                bitmap = block.labelled(label) & (block.ids != own)
                if not bitmap.any():
                    continue
                scores = reached[1].get(key, np.zeros(0, np.int64))
                at, some = positives_in(block, v, bitmap, positives, kth(scores, positives))
                if len(at):
                    reached[1][key] = np.sort(np.concatenate([scores, some]))[-positives:]
                    found.append((np.full(len(at), key), block.ids[at], some))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=["anchor", "id", "score"])

    small_batches(spark, 4)
    met = meeting(groups, blocks, buckets).mapInArrow(first, "anchor bigint, id bigint, score bigint")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = materialize(met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives))
    listed = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positive"))  # at most ``positives`` each
    small_batches(spark, 2048)
    wanted = chosen.join(listed, "anchor").select("id", "label", "v", "anchor", F.col("positive.score").alias("scores"))
    groups = materialize(packed(wanted, GROUP, "anchor scores"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: tuple[int, dict[int, list[list[int]]]] = (-1, {})
        for row in rows_of(batches):
            block, keys = block_of(row), row["a_anchor"].to_numpy()
            if keys[0] != reached[0]:
                reached = (keys[0], {})
            vectors = np.frombuffer(row["a_v"], "<i4").reshape(row["d"], -1).T.astype(np.int64)
            found: list[tuple[np.ndarray, ...]] = []
            for key, label, v, scores in zip(keys, row["a_label"].to_pylist(), vectors, row["a_scores"].to_pylist()):
                windows = reached[1].setdefault(key, [[-(-low * s // 100), high * s // 100] for s in scores])
                bitmap = ~block.labelled(label)
                if not bitmap.any() or all(a > b for a, b in windows):
                    continue
                for place, (at, some) in enumerate(negatives_in(block, v, bitmap, windows, negatives)):
                    if len(at):
                        found.append((np.full(len(at), key), np.full(len(at), place + 1), block.ids[at], some))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names=["anchor", "place", "id", "score"])

    small_batches(spark, 4)
    met = meeting(groups, blocks, buckets).mapInArrow(second, "anchor bigint, place bigint, id bigint, score bigint")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    near = materialize(met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    named = ranked.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(chosen.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return near.join(named, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
