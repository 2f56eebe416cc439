"""Quarantined rows that pass the rules of today go to silver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import functions as F

from tidemark.functions.rules import ENVELOPE_RULES, Rule
from tidemark.operators.quarantine import replay_dlq
from tidemark.operators.silver import DELIVERY, latest_delivery, to_silver, with_day
from tidemark.tables.notes import DayNotes
from tidemark.tables.parquet import ParquetTable


@dataclass(frozen=True)
class ReplayReport:
    """Rows taken out of quarantine, and the silver days that were appended to or rewritten."""

    rescued: int
    days: tuple


def replay_job(
    silver: ParquetTable,
    dlq: ParquetTable,
    rules: Sequence[Rule] = ENVELOPE_RULES,
    codes: Sequence[str] | None = None,
    notes: DayNotes | None = None,
) -> ReplayReport:
    """Check quarantined rows again; what passes is upserted first and deleted from quarantine second.

    A run that dies in between is finished by the next one. A rescued row never replaces one that
    arrived later or at the same time. ``codes`` limits the look to rows that failed for one of them.
    """
    held = dlq.read()
    if codes is not None:
        held = held.filter(F.arrays_overlap("failure_codes", F.array(*[F.lit(c) for c in codes])))
    again = to_silver(replay_dlq(held, rules), keep=(*DELIVERY, "dlq_key", "failure_reason"))
    rescued = again.filter("failure_reason IS NULL").persist()
    try:
        latest = with_day(latest_delivery(rescued)).persist()
        there = silver.find(latest.select("event_id")).select("event_id", F.col("ingest_ts").alias("_arrived"))
        newer = latest.join(there, "event_id", "left").filter("_arrived IS NULL OR ingest_ts > _arrived").drop("_arrived")
        written = silver.upsert(newer, before=notes and notes.before("replay"))
        gone, _ = dlq.delete(rescued.select("dlq_key"))
        latest.unpersist()
        return ReplayReport(gone, written.touched)
    finally:
        rescued.unpersist()
