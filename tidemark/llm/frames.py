"""Small shared helpers: Arrow batch size, reading tables, per-batch mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows in one Arrow batch. Texts may be long, so batches hold few rows; tasks cut them further by characters.
ROWS_PER_BATCH = 256


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Bound what one Arrow batch of whole texts can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def pin_splits(spark: SparkSession) -> None:
    """Keep the splits of file scans as they are now for this session, also if executors come or go between two reads."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> F.Column:
    """A fifth of the documents, by crc32 of the id as text; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch; empty batches never reach it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else (out,)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def with_field(schema: StructType, name: str, kind: str) -> StructType:
    """``schema`` and one more column; ``kind`` as in DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to ``limit`` at most; a larger row is alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
