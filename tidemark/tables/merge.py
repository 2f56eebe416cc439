"""The same operations on a table format that has MERGE and conditional overwrite.

Only statement building can be tested where no such format is installed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TableSpec


class MergeTable:
    """A catalog table, by name, in a format such as delta."""

    def __init__(self, spark: SparkSession, name: str, spec: TableSpec, fmt: str = "delta"):
        self.spark = spark
        self.name = name
        self.spec = spec
        self.fmt = fmt

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        df.write.format(self.fmt).mode("append").saveAsTable(self.name)

    def merge_statement(
        self, source: str, keys: Sequence[str], update: bool, same: Sequence[str] = ()
    ) -> str:
        """MERGE text; ``same`` adds equalities that let the target be pruned."""
        on = " AND ".join(f"t.{c} = s.{c}" for c in (*keys, *same))
        matched = "WHEN MATCHED THEN UPDATE SET * " if update else ""
        return (
            f"MERGE INTO {self.name} t USING {source} s ON {on} "
            f"{matched}WHEN NOT MATCHED THEN INSERT *"
        )

    def _merge(self, df: DataFrame, statement: str, view: str) -> None:
        df.createOrReplaceTempView(view)
        df.sparkSession.sql(statement)

    def upsert(
        self,
        batch: DataFrame,
        keys: Sequence[str] | None = None,
        keys_keep_partition: bool = False,
        before: Callable[[list], None] | None = None,
    ) -> None:
        if before:
            (part,) = self.spec.partition_by
            before(sorted(r[0] for r in batch.select(part).distinct().collect() if r[0] is not None))
        same = self.spec.partition_by if keys_keep_partition else ()
        view = f"{self.spec.name}_upsert"
        statement = self.merge_statement(view, keys or self.spec.keys, True, same)
        self._merge(batch, statement, view)

    def insert_absent(
        self,
        df: DataFrame,
        keys: Sequence[str] | None = None,
        implied_by_key: Sequence[str] = (),
    ) -> None:
        keys = list(keys or self.spec.keys)
        view = f"{self.spec.name}_insert"
        statement = self.merge_statement(view, keys, False, implied_by_key)
        self._merge(df.dropDuplicates(keys), statement, view)

    def replaced(self, as_of: dt.date, also: Sequence[dt.date] = ()) -> str:
        """The days from ``as_of`` on and those in ``also``, as a condition."""
        (part,) = self.spec.partition_by
        window = f"{part} >= DATE'{as_of.isoformat()}'"
        listed = ", ".join(f"DATE'{d.isoformat()}'" for d in also)
        return f"{window} OR {part} IN ({listed})" if listed else window

    def replace_days(
        self, df: DataFrame, as_of: dt.date, days: Sequence[dt.date] | None = None, also: Sequence[dt.date] = ()
    ) -> None:
        where = self.replaced(as_of, also)
        df.filter(where).write.format(self.fmt).mode("overwrite").option("replaceWhere", where).saveAsTable(self.name)
