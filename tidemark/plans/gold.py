"""Recompute the recent days of both gold tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.gold import (
    category_trends_from,
    compact_tallies,
    rating_drift_from,
    recompute_window,
    tallies,
    window_start,
)
from tidemark.tables.merge import MergeTable
from tidemark.tables.notes import DayNotes
from tidemark.tables.parquet import ParquetTable

Table = ParquetTable | MergeTable


@dataclass(frozen=True)
class GoldReport:
    as_of: dt.date
    skipped: bool
    rating_drift_rows: int | None = 0
    category_trends_rows: int | None = 0
    late_days: tuple = ()


def gold_job(
    silver: DataFrame,
    drift: Table,
    trends: Table,
    today: dt.date,
    days: int | None = 2,
    cap_at_today: bool = False,
    notes: DayNotes | None = None,
) -> GoldReport:
    """Rebuild the days of the window; older days stay as they are. ``days=None``: all days.

    Older days that ``notes`` names are rebuilt too, and their notes taken away: rows that arrive
    later than the window reach gold all the same.

    Silver is scanned once. Both tables come from the merged tallies, which are kept
    for the second one. An empty window changes nothing.
    """
    as_of = window_start(today, days)
    seen = notes.read() if notes else {}
    late = sorted({d for noted in seen.values() for d in noted if d < as_of})
    merged = compact_tallies(
        tallies(recompute_window(silver, today, days, cap_at_today, late))
    ).persist()
    try:
        present = sorted(r["day"] for r in merged.select("day").distinct().collect())
        # Without an observation the window stays as it is; noted days that are empty now go all the same.
        if not present and not late:
            return GoldReport(as_of, skipped=True)
        start = as_of if any(d >= as_of for d in present) else dt.date.max
        result = GoldReport(
            as_of,
            False,
            drift.replace_days(rating_drift_from(merged), start, days=present, also=late),
            trends.replace_days(category_trends_from(merged), start, days=present, also=late),
            tuple(late),
        )
        if notes:
            notes.clear(seen)
        return result
    finally:
        merged.unpersist()
