"""Rows that several writes of one run share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tidemark.session import one_machine, workspace
from tidemark.tables import paths


@contextmanager
def kept(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Rows that are used several times, computed once.

    They are written to the shared folder: a later use reads the columns it needs, in as many tasks as their bytes
    ask for. Kept by the executors they would stay in the tasks that made them, and be unpacked row by row. That is
    done only where there is no shared folder.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) or one_machine(spark):
        root = workspace(spark, label)
        try:
            df.write.parquet(f"{root}/rows")
            yield spark.read.schema(df.schema).parquet(f"{root}/rows")
        finally:
            paths.delete(spark, root)
        return
    rows = df.persist()
    try:
        yield rows
    finally:
        rows.unpersist()
