"""Days of silver that changed and that gold has not seen yet, as small files in one directory."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from tidemark.tables import paths


class DayNotes:
    """Whoever changes silver leaves a note of the days before it does; gold takes away what it has recomputed.

    A note left for a write that then failed costs one recompute, and one that a repeated write
    would not leave again is still there.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def add(self, name: str, days: Iterable[dt.date]) -> None:
        """Leave a note; days of an earlier note of this name stay in it."""
        file = f"{self.path}/{name}.json"
        known = json.loads(paths.read_text(self.spark, file) or "[]")
        paths.write_text(self.spark, file, json.dumps(sorted({*known, *(d.isoformat() for d in days)})))

    def before(self, name: str) -> Callable[[Iterable[dt.date]], None]:
        """What an upsert is to call with the days it is about to touch."""
        return lambda days: self.add(name, [d for d in days if d is not None])

    def read(self) -> dict[str, list[dt.date]]:
        files = {n.removesuffix(".new") for n in paths.names(self.spark, self.path)}
        texts = {n: paths.read_text(self.spark, f"{self.path}/{n}") for n in sorted(files)}
        return {n: [dt.date.fromisoformat(d) for d in json.loads(t)] for n, t in texts.items() if t}

    def clear(self, seen: dict[str, list[dt.date]]) -> None:
        """Take away the days that were seen; days that were added since stay."""
        now = self.read()
        for name, days in seen.items():
            rest = {*now.get(name, ())} - {*days}
            paths.delete(self.spark, f"{self.path}/{name}")
            if rest:
                self.add(name.removesuffix(".json"), rest)
