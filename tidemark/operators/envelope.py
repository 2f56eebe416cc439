"""Normalised payloads to keyed, publishable records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.barrier import computed_once
from tidemark.functions.rules import PAYLOAD_RULES, Record, failing_details
from tidemark.functions.text import key_or_unknown, quoted
from tidemark.functions.times import lag_ms, utc_iso
from tidemark.schemas import FAILURES, SCHEMA_VERSION

# Outcomes of the publish side.
REASON_NORMALIZE = "normalize_failed"
REASON_PREPUBLISH = "pre_publish_validation"
SOURCE_ENDPOINT = "businesses/search"

# A random UUID. Freeze it with a write before using the rows twice.
RANDOM_EVENT_ID = "uuid()"
# Partition key of a published event: all events of a business stay in order.
EVENT_KEY = "payload.business_id"
_WITH_NULLS = "map('ignoreNullFields', 'false')"


def content_event_id(*parts: str) -> str:
    """An id in UUID form that is the same whenever the parts are."""
    named = ", ".join(f"'p{i}', cast({p} AS string)" for i, p in enumerate(parts))
    digest = f"sha2(to_json(named_struct({named})), 256)"
    bounds = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return (
        f"concat_ws('-', {', '.join(f'substring({digest}, {a}, {n})' for a, n in bounds)})"
    )


def observation_id(source: str) -> str:
    """Id of one listing in one fetched page: a re-run of the job repeats it."""
    return content_event_id(
        quoted(source), "payload.business_id", "unix_micros(fetched_at)", "search_location",
        "search_term", "position", "listing",
    )


def envelope_of(
    producer_id: str,
    source: str,
    now: str = "current_timestamp()",
    event_id: str = RANDOM_EVENT_ID,
    source_endpoint: str = SOURCE_ENDPOINT,
    fetched_at: str = "fetched_at",
) -> str:
    """The envelope struct around ``payload``."""
    return f"""named_struct(
        'event_id', {event_id},
        'producer_id', {quoted(producer_id)},
        'source', {quoted(source)},
        'source_endpoint', {quoted(source_endpoint)},
        'schema_version', {SCHEMA_VERSION},
        'observed_at', {utc_iso(fetched_at)},
        'ingest_lag_ms', {lag_ms(now, fetched_at)},
        'payload', payload)"""


def stamp(df: DataFrame, producer_id: str, source: str, **args: str) -> DataFrame:
    """Add ``envelope``; arguments as in :func:`envelope_of`."""
    return df.selectExpr("*", f"{envelope_of(producer_id, source, **args)} AS envelope")


def dlq_event_key(*candidates: str) -> str:
    """Key of a quarantined event: the first id there is, else ``unknown``."""
    return key_or_unknown(*candidates)


def outcomes(normalized: DataFrame) -> DataFrame:
    """Label every normalised listing: ``reason`` is null for publishable ones.

    Narrow. ``failures`` is empty for listings that could not be normalised.
    """
    details = failing_details(Record.of_payload("payload"), PAYLOAD_RULES)
    failures = f"CASE WHEN normalize_failed THEN cast(array() AS {FAILURES}) ELSE {details} END"
    return computed_once(normalized, "failures", failures).selectExpr(
        "*",
        f"""CASE WHEN normalize_failed THEN '{REASON_NORMALIZE}'
            WHEN size(failures) > 0 THEN '{REASON_PREPUBLISH}' END AS reason""",
    )


_UNNORMALISED = f"reason = '{REASON_NORMALIZE}'"
_RAW_KEY = dlq_event_key(
    "get_json_object(listing, '$.business_id')", "get_json_object(listing, '$.id')"
)
_DLQ_KEY = (
    f"CASE WHEN {_UNNORMALISED} THEN {_RAW_KEY} ELSE {dlq_event_key('payload.business_id')} END"
)


def _dlq_record(producer_id: str) -> str:
    """A quarantine record, built as text so that a raw body is embedded as it came."""
    head = f"""to_json(named_struct('producer_id', {quoted(producer_id)}, 'reason', reason,
        'failures', failures, 'observed_at', {utc_iso('fetched_at')}))"""
    body = f"CASE WHEN {_UNNORMALISED} THEN listing ELSE to_json(payload, {_WITH_NULLS}) END"
    return f"""concat(substring({head}, 1, length({head}) - 1), ',"payload":', {body}, '}}')"""


def prepublish_split(
    labelled: DataFrame, producer_id: str, source: str, **stamp_args: str
) -> tuple[DataFrame, DataFrame]:
    """(stamped envelopes of publishable listings, quarantine records of the rest).

    A quarantine record carries the normalised payload, or the raw listing where
    there is none.
    """
    valid = stamp(labelled.filter("reason IS NULL"), producer_id, source, **stamp_args)
    invalid = labelled.filter("reason IS NOT NULL").selectExpr(
        "*", f"{_DLQ_KEY} AS dlq_key", f"{_dlq_record(producer_id)} AS dlq_record"
    )
    return valid, invalid


def publish_records(
    labelled: DataFrame,
    producer_id: str,
    source: str,
    raw_topic: str,
    dlq_topic: str,
    instead: str = "NULL",
    instead_value: str = "NULL",
    **stamp_args: str,
) -> DataFrame:
    """``(topic, key, value)`` of every listing, published and quarantined in one pass.

    Rows that are no listing have another topic, ``instead``, with a text of their own.
    """
    envelope = f"to_json({envelope_of(producer_id, source, **stamp_args)}, {_WITH_NULLS})"

    def either(published: str, quarantined: str) -> str:
        return f"CASE WHEN reason IS NULL THEN {published} ELSE {quarantined} END"

    topics = f"coalesce({instead}, {either(quoted(raw_topic), quoted(dlq_topic))})"
    other = f"({instead}) IS NOT NULL"
    if instead == "NULL":
        topics, other = either(quoted(raw_topic), quoted(dlq_topic)), "false"
    return labelled.selectExpr(
        f"{topics} AS topic",
        f"CASE WHEN {other} THEN 'unknown' ELSE {either(EVENT_KEY, _DLQ_KEY)} END AS key",
        f"CASE WHEN {other} THEN {instead_value} ELSE {either(envelope, _dlq_record(producer_id))} END AS value",
    )


def to_kafka_records(df: DataFrame, topic: str, key: str, value: str) -> DataFrame:
    """``(topic, key, value)`` rows for a Kafka write or a JSONL mirror."""
    return df.selectExpr(f"{quoted(topic)} AS topic", f"{key} AS key", f"{value} AS value")


def sweep_report(labelled: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages, listings seen, accepted and rejected per search, plus a total row (``is_total``).

    Searches without a single listing are reported too, and those without a term or place. Both
    inputs are aggregated before they meet; the total row has null search columns.
    """
    search = ["search_location", "search_term"]
    counts = ("pages_fetched", "businesses_seen", "accepted", "rejected")
    fetched = pages.groupBy(*search).agg(F.count(F.lit(1)).alias("pages_fetched"))
    seen = labelled.groupBy(*[F.col(c).alias(f"_{c}") for c in search]).agg(
        F.count(F.lit(1)).alias("businesses_seen"),
        F.expr("count_if(reason IS NULL)").alias("accepted"),
        F.expr("count_if(reason IS NOT NULL)").alias("rejected"),
    )
    same = F.col(search[0]).eqNullSafe(F.col(f"_{search[0]}")) & F.col(search[1]).eqNullSafe(F.col(f"_{search[1]}"))
    per_search = fetched.join(seen, same, "left").selectExpr(
        *search, "search_location AS city", *[f"coalesce({c}, 0L) AS {c}" for c in counts]
    )
    return per_search.groupingSets([search, []], *search).agg(
        (F.grouping_id() != 0).alias("is_total"),
        F.count_distinct("city").alias("cities_attempted"),
        *[F.sum(c).alias(c) for c in counts],
    )
