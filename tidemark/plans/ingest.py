"""Search-response pages to publishable records, in one narrow plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import quoted
from tidemark.operators.envelope import (
    observation_id,
    outcomes,
    publish_records,
    sweep_report,
)
from tidemark.operators.normalize import normalize
from tidemark.sources.pages import explode_listings, explode_pages, failed_pages
from tidemark.tables.parquet import observed


@dataclass(frozen=True)
class Sweep:
    """Lazy outputs of one sweep.

    ``records`` holds the rows of both topics, so that one pass over the pages feeds
    one write; ``report`` is a separate, aggregating query.
    """

    records: DataFrame
    report: DataFrame
    failed_pages: DataFrame


def ingest(
    pages: DataFrame,
    producer_id: str,
    source: str,
    raw_topic: str,
    dlq_topic: str,
    now: str = "current_timestamp()",
    event_id: str | None = None,
) -> Sweep:
    """Explode, normalise, validate and envelope a frame of fetched pages.

    ``pages`` has ``body, search_term, search_location, fetched_at``. Event ids are
    derived from content unless given, so that a repeated job publishes the same
    events.
    """
    labelled = outcomes(normalize(explode_listings(pages)))
    return Sweep(
        records=publish_records(
            labelled,
            producer_id,
            source,
            raw_topic,
            dlq_topic,
            now=now,
            event_id=observation_id(source) if event_id is None else event_id,
        ),
        report=sweep_report(labelled, pages),
        failed_pages=failed_pages(pages),
    )


@dataclass(frozen=True)
class SweepPass:
    """Records of one sweep whose write also counts it.

    ``records`` has the rows of all three topics: published, quarantined, and pages that cannot be read.
    """

    records: DataFrame
    seen: Observation

    def totals(self) -> dict[str, int]:
        """What the sweep held; known when the records have been written."""
        found = observed(self.seen) or {}
        places = found.get("cities") or []
        return {"cities_attempted": len(places), **{c: found.get(c) or 0 for c in _COUNTED}}


_COUNTED = {
    "pages_fetched": "coalesce(position, 0) = 0",
    "failed_pages": "page_failed",
    "businesses_seen": "position IS NOT NULL",
    "accepted": "position IS NOT NULL AND reason IS NULL",
    "rejected": "position IS NOT NULL AND reason IS NOT NULL",
}


def ingest_pass(
    pages: DataFrame,
    producer_id: str,
    source: str,
    raw_topic: str,
    dlq_topic: str,
    failed_topic: str,
    now: str = "current_timestamp()",
    event_id: str | None = None,
) -> SweepPass:
    """As :func:`ingest`, with one parse of each body for records, failed pages and totals.

    A page that cannot be read becomes a record of ``failed_topic``: the page's row as JSON, its body included.
    """
    labelled = outcomes(normalize(explode_pages(pages)))
    seen = Observation()
    counted = labelled.observe(
        seen, F.collect_set("search_location").alias("cities"),
        *[F.expr(f"count_if({test})").alias(name) for name, test in _COUNTED.items()],
    )
    row = ", ".join(f"{quoted(c)}, {'failed_body' if c == 'body' else c}" for c in pages.columns)
    records = publish_records(
        counted, producer_id, source, raw_topic, dlq_topic, now=now,
        event_id=observation_id(source) if event_id is None else event_id,
        instead=f"CASE WHEN position IS NOT NULL THEN NULL WHEN page_failed THEN {quoted(failed_topic)} ELSE '' END",
        instead_value=f"to_json(named_struct({row}))",
    )
    return SweepPass(records.filter("topic <> ''"), seen)
