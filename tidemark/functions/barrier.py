"""Compute an expensive column once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def computed_once(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a column that filters above it will not pull below it.

    Catalyst pushes a filter through a projection by copying the projection's
    expressions into the predicate, so filtering on something derived from a JSON
    parse would parse each row again for every mention. Generators are not
    crossed; exploding a one-element array keeps the row count and stops that.
    The value itself is computed by a projection, where it is code-generated.
    """
    columns = [f"`{c}`" for c in df.columns]
    staged = df.selectExpr(*columns, f"{value} AS _staged")
    return staged.selectExpr(*columns, f"explode(array(_staged)) AS {name}")
