"""Create the schemas and the five tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from tidemark.functions.text import quoted
from tidemark.schemas import ALL_TABLES, TableSpec


def schema_statements(tables: Iterable[TableSpec] = ALL_TABLES, catalog: str = "") -> list[str]:
    prefix = f"{catalog}." if catalog else ""
    names = dict.fromkeys(t.schema_name for t in tables)
    return [f"CREATE SCHEMA IF NOT EXISTS {prefix}{name}" for name in names]


def table_statement(
    spec: TableSpec,
    catalog: str = "",
    fmt: str = "parquet",
    root: str = "",
    properties: dict[str, str] | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS``: running it again alters nothing.

    Required columns are ``NOT NULL`` where the format enforces it; plain files do not. With ``root`` the table lies at ``<root>/<schema>/<name>``, where the path-based
    writers put it.
    """
    prefix = f"{catalog}." if catalog else ""
    columns = ", ".join(
        f"{column} NOT NULL" if column.split()[0] in spec.required and fmt != "parquet" else column
        for column in spec.columns.split(", ")
    )
    text = f"CREATE TABLE IF NOT EXISTS {prefix}{spec.full_name} ({columns}) USING {fmt}"
    if spec.partition_by:
        text += f" PARTITIONED BY ({', '.join(spec.partition_by)})"
    if root:
        text += f" LOCATION '{location(spec, root)}'"
    if properties:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        text += f" TBLPROPERTIES ({pairs})"
    return text


def location(spec: TableSpec, root: str) -> str:
    return f"{root.rstrip('/')}/{spec.schema_name}/{spec.name}"


def bootstrap(
    spark: SparkSession,
    catalog: str = "",
    fmt: str = "parquet",
    root: str = "",
    properties: dict[str, str] | None = None,
    tables: Iterable[TableSpec] = ALL_TABLES,
) -> None:
    """Create what is missing."""
    tables = list(tables)
    for statement in schema_statements(tables, catalog):
        spark.sql(statement)
    for spec in tables:
        spark.sql(table_statement(spec, catalog, fmt, root, properties))


def sync_partitions(spark: SparkSession, spec: TableSpec, catalog: str = "") -> None:
    """Let the catalog see partitions that were written by path."""
    name = f"{catalog}.{spec.full_name}" if catalog else spec.full_name
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
