"""Documents to packed training sequences: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and
returns the columns of ``documents`` (the last returns pieces of sequences).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, ngram_join, packing, quality
from tidemark.llm.frames import held_out, pin_splits, table
from tidemark.session import scratch_path

MIN_QUALITY = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; what reads like none of them, or has no letter, goes."""
    found = language.identify(docs, docs.where(~held_out()), out="_language")
    return found.where(~F.col("_language.rejected")).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours' vote for quality is ``MIN_QUALITY`` or more."""
    found = quality.classify(docs, docs, table(spark, sf_dir, "labels").where(~held_out()), out="_quality")
    return found.where(F.col("_quality.score") >= MIN_QUALITY).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; of its repeated rows the first."""
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("row"))
    pin_splits(spark)
    named = docs.select(row.alias("_pipeline_row"), *docs.columns)  # a file scan with pinned splits gives the same row numbers again
    groups = ngram_join.similar(named, id_col="_pipeline_row")
    gone = groups.where("_pipeline_row != component_id").select(F.col("_pipeline_row.row").alias("_gone"))
    return named.join(gone, F.col("_pipeline_row.row") == F.col("_gone"), "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(mixing.mix(docs, out="_mix"), out="_mix").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Models and tokenizers are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
