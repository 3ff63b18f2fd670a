"""Queries over the given tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import queries as q
from . import file_queries, sheet_queries  # their queries join those of q


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of each sample in each replicate-supported region, with the sample's factor and robust CPM scale."""
    return q.QUERIES["flagship"](spark, sf_dir)


def queries() -> dict:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)


__all__ = ["entry", "file_queries", "oracle_sql", "queries", "sheet_queries"]
