"""Idempotent keyed writes on partitioned parquet.

Parquet has no MERGE, so writes are laid out to be repeatable instead:

* new rows are appended, which touches no existing file;
* only partitions that hold a changed row are rewritten. Their next content is complete
  in a hidden side directory before a marker makes the replacement binding; then whole
  partition directories are moved into place, nothing is written twice. If the driver dies
  in between, every write finishes the replacement first, and a reader takes the
  partitions that are not yet moved from the side directory.

Repeating any call gives the same table. One writer per table; a reader that lists
files while directories are moved can see a mix of old and new partitions, or fail and
be repeated. Where a store has no cheap rename, use a format with MERGE.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import TableSpec
from tidemark.tables import paths
from tidemark.tables.kept import kept
from tidemark.tables.keys import HASH, KeyIndex, row_hash

#: A scan is narrowed by a list of keys up to so many, and by so many ranges.
LISTED, GROUPS = 512, 64
_MODE = "partitionOverwriteMode"


@dataclass(frozen=True)
class UpsertReport:
    """Rows appended, partitions rewritten because a row in them changed, and all that were touched."""

    appended: int
    rewritten: tuple
    touched: tuple = ()


class ParquetTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.parts = spec.partition_by
        self.index = KeyIndex(self)
        self._pending = f"{self.path}/_pending"
        self._binding = f"{self._pending}/_binding.json"

    # -- partitions ------------------------------------------------------------
    # A partition is named by its column's value, or by a tuple where there are several columns.

    def directory(self, value: object) -> str:
        """``a=1/b=2``: where the rows of a partition lie."""
        values = value if len(self.parts) > 1 else (value,)
        return "/".join(paths.partition_name(self.spark, c, v) for c, v in zip(self.parts, values, strict=True))

    def value_of(self, directory: str) -> object:
        kinds = dict(c.split(" ", 1) for c in self.spec.columns.split(", "))
        values = []
        for level in directory.split("/"):
            column, _, text = level.partition("=")
            read = paths.unescaped(self.spark, text)
            convert = {"date": dt.date.fromisoformat, "int": int, "bigint": int}.get(kinds[column], str)
            values.append(None if read is None else convert(read))
        return tuple(values) if len(values) > 1 else values[0]

    def partitions(self) -> list:
        """All partitions, by their directories: neither rows nor footers are read."""
        return [self.value_of(name) for name in paths.leaves(self.spark, self.path, len(self.parts))]

    def partition_values(self, df: DataFrame, *_: str) -> list:
        """Distinct partitions of rows; as many as the table has partitions."""
        rows = [tuple(r) if len(self.parts) > 1 else r[0] for r in df.select(*self.parts).distinct().collect()]
        return sorted(rows, key=str)

    def inside(self, values: Sequence) -> Column:
        """Whether a row lies in one of the partitions; reaches the scan as a partition filter."""
        return _within(self.parts, [v if len(self.parts) > 1 else (v,) for v in values])

    # -- reading ---------------------------------------------------------------

    def exists(self) -> bool:
        return paths.exists(self.spark, self.path)

    def read(self) -> DataFrame:
        """The table, with its declared schema; empty if nothing was written yet."""
        if not self.exists():
            return self.spark.createDataFrame([], self.spec.columns)
        replaced = self._replacement()
        if replaced is None:
            return self._load(self.path)
        staged = set(paths.leaves(self.spark, f"{self._pending}/rows", len(self.parts)))
        waiting = [self.value_of(name) for name, filled in replaced if filled and name in staged]
        emptied = [self.value_of(name) for name, filled in replaced if not filled]
        live = self._load(self.path).filter(~self.inside([*waiting, *emptied]))
        if not waiting:
            return live
        return live.unionByName(self._load(f"{self._pending}/rows").filter(self.inside(waiting)))

    def _replacement(self) -> list | None:
        """(directory, filled) of each partition of a binding replacement, if there is one."""
        text = paths.read_text(self.spark, self._binding)
        return None if text is None else json.loads(text)

    def _load(self, path: str) -> DataFrame:
        rows = self.spark.read.schema(self.spec.columns).parquet(path)
        return rows.select(*self.spec.column_names)

    # -- writing ---------------------------------------------------------------

    def laid_out(self, df: DataFrame) -> DataFrame:
        """Group rows by partition without tying a partition to one task.

        Adaptive execution splits a large partition and joins small ones; rows are
        then clustered inside each file.
        """
        if self.spec.partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in self.spec.partition_by])
        order = [*self.spec.partition_by, *self.spec.cluster_by]
        return df.sortWithinPartitions(*order) if self.spec.cluster_by else df

    def append(self, df: DataFrame) -> int:
        """Append rows; returns how many."""
        self.recover()
        self.index.forget()
        return self._append(df)

    def _append(self, df: DataFrame) -> int:
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._writer(self.laid_out(rows), "append").parquet(self.path)
        return _observed_rows(seen)

    def upsert(
        self,
        batch: DataFrame,
        keys: Sequence[str] | None = None,
        keys_keep_partition: bool = False,
        before: Callable[[list], None] | None = None,
    ) -> UpsertReport:
        """Update rows whose key exists, insert the rest. Keys are unique in ``batch``.

        The batch is joined once with the keys and row hashes beside the table (see ``keys``). A
        batch that changes nothing writes nothing; rows of the table are read only where a
        partition is rewritten. Where a key can never move to another partition (an event keeps its
        observation time), ``keys_keep_partition`` limits the join to the batch's own partitions.
        ``before`` is told the partitions that are about to be touched.
        """
        keys = list(keys or self.spec.keys)
        own = tuple(keys) == self.spec.keys
        self.recover()
        empty = not self.exists()
        batch = batch.select(*self.spec.column_names)
        if keys_keep_partition:
            batch = batch.persist()  # its days are asked for first
        try:
            with kept(self._judged(batch, keys, own, empty, keys_keep_partition), "judged") as judged:
                return self._apply(judged, keys, own, empty, before)
        finally:
            batch.unpersist()

    def _apply(
        self, judged: DataFrame, keys: list[str], own: bool, empty: bool, before: Callable[[list], None] | None
    ) -> UpsertReport:
        """Append new rows, rewrite the partitions of changed ones, and bring the keys up to date."""
        found = judged.filter("_status <> 'same'").groupBy("_status", *self.parts, *map(_old, self.parts)).count().collect()
        changed, new = set(), {}
        for r in found:
            here, there = (self._value(r[c] for c in names) for names in (self.parts, [*map(_old, self.parts)]))
            if r["_status"] == "new":
                new[here] = new.get(here, 0) + r["count"]
            else:
                changed |= {here, there}
        fresh = {v: n for v, n in new.items() if v not in changed}
        touched = sorted({*fresh, *changed}, key=str)
        if before and touched:
            before(touched)
        if own:
            self.index.mark(touched)
        added = judged.filter("_status = 'new'").filter(~self.inside(list(changed)))
        if fresh:
            self._writer(self.laid_out(added.select(*self.spec.column_names)), "append").parquet(self.path)
        if changed:
            rows = judged.filter(self.inside(list(changed))).select(*self.spec.column_names)
            old = self.read().filter(self.inside(list(changed)))
            survivors = old.join(judged.select(*keys), keys, "left_anti")
            self._replace(survivors.unionByName(rows), list(changed))
        if own and (fresh or changed):
            self._index_batch(added.select(*keys, *self.parts, HASH), list(changed), empty, bool(fresh))
        elif not own:
            self.index.forget()
        return UpsertReport(sum(fresh.values()), tuple(sorted(changed, key=str)), tuple(touched))

    def _judged(self, batch: DataFrame, keys: list[str], own: bool, empty: bool, keep: bool) -> DataFrame:
        """The batch with each row's hash, its row's partition in the table, and whether it is new, changed or the same."""
        old = [*map(_old, self.parts)]
        rest = [c for c in self.spec.column_names if c not in keys]
        if empty:
            kinds = dict(batch.dtypes)
            none = [F.lit(None).cast(kinds[c]).alias(_old(c)) for c in self.parts]
            return batch.select("*", row_hash(batch, rest).alias(HASH), *none, F.lit("new").alias("_status"))
        known = self.index.read() if own else self.index.entries(self.read(), keys)
        if keep:
            known = known.filter(self.inside(self.partition_values(batch)))
        known = known.select(*keys, *[F.col(c).alias(_old(c)) for c in self.parts], F.col(HASH).alias("_old_hash"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(_old(c))) for c in self.parts], F.col(HASH) == F.col("_old_hash"))
        status = F.when(F.col("_old_hash").isNull(), "new").when(same, "same").otherwise("changed")
        judged = batch.withColumn(HASH, row_hash(batch, rest)).join(known, keys, "left").withColumn("_status", status)
        return judged.select(*self.spec.column_names, HASH, *old, "_status")

    def _index_batch(self, added: DataFrame, changed: list, empty: bool, fresh: bool) -> None:
        if empty:
            self.index.create(added)
            return
        if fresh:
            self.index.add(added)
        if changed:
            self.index.refresh(changed)
        self.index.settled()

    def _value(self, values: Iterable) -> object:
        values = tuple(values)
        return values if len(values) > 1 else values[0]

    def find(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is among ``keys``; only the partitions that hold one are read."""
        own = list(self.spec.keys)
        if not self.exists():
            return self.read()
        hits = self.partition_values(self.index.read().join(keys.select(*own), own, "left_semi"))
        return self.read().filter(self.inside(hits)).join(keys.select(*own), own, "left_semi")

    def delete(self, keys: DataFrame, on: Sequence[str] | None = None) -> tuple[int, tuple]:
        """Remove the rows whose key is among ``keys``; returns how many, and the partitions rewritten."""
        on = list(on or self.spec.keys)
        self.recover()
        if not self.exists():
            return 0, ()
        keys = keys.select(*on).distinct()
        hits = self.read().join(keys, on, "left_semi").groupBy(*self.parts).count().collect()
        values = sorted((self._value(r[c] for c in self.parts) for r in hits), key=str)
        if values:
            self.overwrite(self.read().filter(self.inside(values)).join(keys, on, "left_anti"), values)
        return sum(r["count"] for r in hits), tuple(values)

    def insert_absent(
        self,
        df: DataFrame,
        keys: Sequence[str] | None = None,
        implied_by_key: Sequence[str] = (),
    ) -> int:
        """Append rows whose key is not in the table yet; returns how many.

        ``implied_by_key`` names columns that are equal whenever the keys are: the range of the last
        within each value of those before lets the scan of existing keys skip files. A small
        batch also names its keys, so that row groups are skipped where the range says nothing.
        """
        keys = list(keys or self.spec.keys)
        self.recover()
        self.index.forget()
        with kept(df.select(*self.spec.column_names).dropDuplicates(keys), "insert") as rows:
            if not self.exists():
                return self._append(rows)
            known = self.read()
            if implied_by_key:
                where = self._where_keys_can_be(rows, keys, list(implied_by_key))
                if where is None:
                    return 0
                known = known.filter(where)
            return self._append(rows.join(known.select(*keys), keys, "left_anti"))

    @staticmethod
    def _where_keys_can_be(rows: DataFrame, keys: list[str], implied: list[str]) -> Column | None:
        """A filter that no row with one of the keys fails, for the scan; null if there are no rows."""
        *groups, last = implied
        edges = rows.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("rows"), F.count(last).alias("some"), F.min(last).alias("lo"), F.max(last).alias("hi")
        ).filter("rows > 0").limit(GROUPS + 1).collect()
        if not edges:
            return None
        if sum(e["rows"] for e in edges) <= LISTED and len(keys) == 1 and len(edges) <= GROUPS:
            listed = F.col(keys[0]).isin([r[0] for r in rows.select(*keys).filter(F.col(keys[0]).isNotNull()).collect()])
        else:
            listed = F.lit(True)
        if len(edges) > GROUPS:
            return F.lit(True)
        found = []
        for e in edges:
            own = [F.col(c) == e[c] if e[c] is not None else F.col(c).isNull() for c in groups]
            # Where there is no value at all, the range says nothing.
            inside = F.col(last).between(e["lo"], e["hi"])
            if e["some"] == e["rows"]:
                own.append(inside)
            elif e["some"]:
                own.append(inside | F.col(last).isNull())
            found.append(reduce(and_, own, F.lit(True)))
        return reduce(or_, found) & listed

    def replace_days(
        self, df: DataFrame, as_of: dt.date, days: Sequence[dt.date] | None = None, also: Sequence[dt.date] = ()
    ) -> int:
        """Make ``df`` the content of all days from ``as_of`` on and of those in ``also``; returns rows written.

        Other days are untouched; replaced days without rows in ``df`` disappear.
        ``df`` must not read this table. ``days`` are the days in ``df``, if known.
        """
        (part,) = self.parts
        self.recover()
        self.index.forget()
        df = df.filter((F.col(part) >= F.lit(as_of)) | self.inside(also))
        old = [d for d in self.partitions() if d is not None and (d >= as_of or d in also)]
        new = set(self.partition_values(df) if days is None else days)
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._writer(self.laid_out(rows), "overwrite").option(_MODE, "dynamic").parquet(self.path)
        self._drop(d for d in old if d not in new)
        return _observed_rows(seen)

    def overwrite(self, rows: DataFrame, values: Sequence, laid_out: bool = False, same_rows: bool = False) -> None:
        """Make ``rows`` the whole content of the listed partitions.

        ``rows`` may read this table: they are complete elsewhere before any live
        file goes. ``laid_out`` rows keep the distribution they come with; ``same_rows`` are
        those that are there, in other files.
        """
        if not same_rows:
            self.index.mark(values)
        self._replace(rows, values, laid_out)

    def _replace(self, rows: DataFrame, values: Sequence, laid_out: bool = False) -> None:
        if not laid_out:
            rows = self.laid_out(rows)
        self._writer(rows, "overwrite").parquet(f"{self._pending}/rows")
        staged = set(paths.leaves(self.spark, f"{self._pending}/rows", len(self.parts)))
        names = [self.directory(v) for v in values]
        # Written last, and at once: it is what makes the replacement binding.
        paths.write_text(self.spark, self._binding, json.dumps([(n, n in staged) for n in names]))
        self.recover()

    def recover(self) -> None:
        """Finish a replacement a previous run left behind, or discard its start.

        Directories are moved one by one. One that is no longer staged was moved before, so
        any number of crashes in here ends in the same table.
        """
        if not paths.exists(self.spark, self._pending):
            return
        for name, filled in self._replacement() or ():
            staged, live = f"{self._pending}/rows/{name}", f"{self.path}/{name}"
            if not filled:
                paths.delete(self.spark, live)
            elif paths.exists(self.spark, staged):
                paths.delete(self.spark, live)
                paths.move(self.spark, staged, live)
        paths.delete(self.spark, self._pending)

    def drop_partitions(self, values: Iterable) -> None:
        """Remove whole partitions."""
        self.recover()
        values = list(values)
        self.index.mark(values)
        self._drop(values)

    # -- helpers ---------------------------------------------------------------

    def _writer(self, df: DataFrame, mode: str):
        return df.write.mode(mode).partitionBy(*self.parts)

    def _drop(self, values: Iterable) -> None:
        for value in values:
            paths.delete(self.spark, f"{self.path}/{self.directory(value)}")


def observed(seen: Observation) -> dict | None:
    """What was observed; null where the plan was found to be empty before it ran."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" in str(error.java_exception.toString()):
            return None
        raise


def _observed_rows(seen: Observation) -> int:
    return (observed(seen) or {"rows": 0})["rows"]


def _old(column: str) -> str:
    return f"_old_{column}"


def _within(parts: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether a row lies in the listed partitions; never null."""
    if not values:
        return F.lit(False)
    part, *rest = parts
    if rest:
        first: dict[object, list[tuple]] = {}
        for value, *more in values:
            first.setdefault(value, []).append(tuple(more))
        return reduce(or_, [F.col(part).eqNullSafe(F.lit(v)) & _within(rest, more) for v, more in first.items()])
    known = [v for (v,) in values if v is not None]
    inside = F.coalesce(F.col(part).isin(known), F.lit(False)) if known else F.lit(False)
    return inside | F.col(part).isNull() if len(known) < len(values) else inside
