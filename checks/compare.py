"""Run queries against their SQL counterparts and compare whole results.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import oracle, queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return list(value) if hasattr(value, "tolist") else value


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, _sorted(df.select(*names).collect())


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = con.sql(sql)
    names = sorted(relation.columns)
    quoted = ", ".join(f'"{n}"' for n in names)
    return names, _sorted(relation.project(quoted).fetchall())


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """Why the two results differ, or None."""
    got_names, got = spark_rows(queries.registry()[name](spark, sf_dir))
    want_names, want = oracle_rows(con, oracle.statements()[name])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None if got else "both empty"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries.registry())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            why = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            why = f"{type(error).__name__}: {str(error)[:600]}"
        bad += why is not None
        print(f"{'ok  ' if why is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              + (f"\n     {why}" if why else ""), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
