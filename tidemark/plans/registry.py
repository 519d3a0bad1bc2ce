"""All registered queries and their oracles, with every query module imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import ml_queries, stream_queries  # noqa: F401  (they register on import)
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.queries import QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
