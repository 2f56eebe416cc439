"""Hand-made rows for tests."""

from __future__ import annotations

import copy
import json

GOOD_PAYLOAD = {
    "business_id": "b1",
    "name": "Lantern & Page",
    "rating": 3.5,
    "review_count": 37,
    "categories": ["bookstores", "tea"],
    "coordinates": {"latitude": 63.43, "longitude": 10.395},
    "location": {"city": "Trondheim"},
    "search_term": "bookshops",
    "search_location": "Harbour Quarter",
}
GOOD_ENVELOPE = {
    "event_id": "e1",
    "producer_id": "p1",
    "source": "listings",
    "source_endpoint": "businesses/search",
    "schema_version": 1,
    "observed_at": "2026-06-09T12:00:00+00:00",
    "ingest_lag_ms": 0,
    "payload": GOOD_PAYLOAD,
}
BRONZE_DDL = (
    "ingest_ts timestamp, kafka_topic string, kafka_partition int, kafka_offset bigint, "
    "kafka_key string, raw_envelope string"
)
MISSING = object()


def envelope(event_id="e1", observed_at="2026-06-09T12:00:00+00:00", **changes) -> str:
    """Envelope text; a dotted change sets a payload member, MISSING removes it."""
    doc = copy.deepcopy(GOOD_ENVELOPE)
    doc.update(event_id=event_id, observed_at=observed_at)
    for path, value in changes.items():
        target = doc["payload"]
        *parents, leaf = path.split("__")
        for parent in parents:
            target = target[parent]
        if value is MISSING:
            target.pop(leaf, None)
        else:
            target[leaf] = value
    return json.dumps(doc)


def bronze(spark, texts, start=0, minute=0):
    """Bronze rows of the given texts, offsets counted from ``start``."""
    rows = [(i, text, start + i, minute) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "i int, raw_envelope string, o long, m int").selectExpr(
        "timestamp'2026-06-09 12:00:00Z' + make_dt_interval(0, 0, m) AS ingest_ts",
        "'t' AS kafka_topic", "0 AS kafka_partition", "o AS kafka_offset",
        "'k' AS kafka_key", "raw_envelope",
    )
