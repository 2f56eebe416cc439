"""Keyed tables over plain parquet directories, or over a table format with MERGE."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.schemas import TableSpec
from tidemark.tables.merge import MergeTable
from tidemark.tables.parquet import ParquetTable


def open_table(
    spark: SparkSession, path: str, spec: TableSpec, fmt: str = "parquet"
) -> ParquetTable | MergeTable:
    """The adapter for ``fmt``; any format but parquet must support MERGE."""
    if fmt == "parquet":
        return ParquetTable(spark, path, spec)
    return MergeTable(spark, path, spec, fmt)


__all__ = ["MergeTable", "ParquetTable", "open_table"]
