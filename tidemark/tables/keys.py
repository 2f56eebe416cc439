"""The side table of a keyed parquet table: where each key lies, and what its row hashes to.

It lies in a hidden directory beside the table and has the table's partitions, so that a partition goes with its
keys and only touched partitions are ever read again. A batch is joined with it once, which tells new rows from changed
and equal ones without a look at the table. Whoever writes the table names the partitions it is about to touch first;
the note is taken away when their keys are up to date. If a driver dies in between, the keys of the named partitions
are read from the table before they are used.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tidemark.tables import paths

if TYPE_CHECKING:
    from tidemark.tables.parquet import ParquetTable

HASH = "_row_hash"


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """64 bits of a row's values. Nulls count by their place: the plain hash passes over them."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    values = [F.to_json(F.col(c)) if c in nested else F.col(c) for c in columns]
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(*values, nulls)


class KeyIndex:
    def __init__(self, table: ParquetTable):
        self._table = table
        self.spark = table.spark
        self.path = f"{table.path}/_keys"
        self._note = f"{table.path}/_keys_stale.json"

    def exists(self) -> bool:
        """Whether it was completed once; a start that a dead driver left behind is no index."""
        return paths.exists(self.spark, f"{self.path}/_SUCCESS")

    def entries(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        rest = [c for c in self._table.spec.column_names if c not in keys]
        return rows.select(*keys, *self._table.parts, row_hash(rows, rest).alias(HASH))

    def read(self) -> DataFrame:
        """Keys of all rows; built from the table if there is no index yet."""
        if not self.exists():
            self.create(self.entries(self._table.read(), self._table.spec.keys))
        self.repair()
        kinds = dict(self._table.read().dtypes)
        columns = [*self._table.spec.keys, *self._table.parts]
        schema = ", ".join([f"{c} {kinds[c]}" for c in columns] + [f"{HASH} bigint"])
        return self.spark.read.schema(schema).parquet(self.path)

    def create(self, entries: DataFrame) -> None:
        self._write(entries, "overwrite")
        paths.delete(self.spark, self._note)

    def add(self, entries: DataFrame) -> None:
        self._write(entries, "append")

    def mark(self, values: Iterable) -> None:
        """Name partitions whose keys may be wrong until they are refreshed."""
        if self.exists():
            names = {*self._marked(), *(self._table.directory(v) for v in values)}
            if names:
                paths.write_text(self.spark, self._note, json.dumps(sorted(names)))

    def settled(self) -> None:
        """All marked partitions are up to date."""
        paths.delete(self.spark, self._note)
        paths.delete(self.spark, f"{self._note}.new")

    def repair(self) -> None:
        names = self._marked()
        if names:
            self.refresh([self._table.value_of(n) for n in names])
            self.settled()

    def refresh(self, values: Sequence) -> None:
        """Read the keys of some partitions from the table."""
        there = [v for v in values if paths.exists(self.spark, f"{self._table.path}/{self._table.directory(v)}")]
        for gone in set(values) - set(there):
            paths.delete(self.spark, f"{self.path}/{self._table.directory(gone)}")
        if there:
            rows = self._table.read().filter(self._table.inside(there))
            self._write(self.entries(rows, self._table.spec.keys), "overwrite", partitionOverwriteMode="dynamic")

    def forget(self) -> None:
        """Take the index away, after a write that did not keep it; the next upsert builds it anew."""
        paths.delete(self.spark, self.path)
        self.settled()

    def _marked(self) -> list[str]:
        text = paths.read_text(self.spark, self._note)
        return json.loads(text) if text else []

    def _write(self, entries: DataFrame, mode: str, **options: str) -> None:
        parts = self._table.parts
        rows = entries.hint("rebalance", *[F.col(c) for c in parts])
        rows.write.mode(mode).options(**options).partitionBy(*parts).parquet(self.path)
