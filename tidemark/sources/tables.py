"""Parquet table access for the driver-provided test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_name(target: str) -> bool:
    """A catalog name (``table``, ``schema.table``) rather than a folder."""
    return "/" not in target and ":" not in target


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.table(target) if is_name(target) else spark.read.parquet(target)


def write_target(writer: DataFrameWriter, target: str) -> None:
    """Parquet at a folder, or a catalog table of that name."""
    if is_name(target):
        writer.format("parquet").saveAsTable(target)
    else:
        writer.parquet(target)
