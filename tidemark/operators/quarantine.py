"""Quarantine rows: stable key, reason, codes and the original text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.barrier import computed_once
from tidemark.functions.rules import ENVELOPE_RULES, Rule, failing_codes
from tidemark.functions.text import content_key
from tidemark.functions.times import utc_day
from tidemark.operators.decode import DECODED, decode
from tidemark.schemas import DLQ_COLUMNS

# Reasons and the code of text that is not a JSON object.
REASON_RULES = "silver_validation"
REASON_PARSE = "envelope_parse_failed"
CODE_PARSE = "unparseable_envelope"

_KEY_PARTS = ("kafka_topic", "kafka_partition", "kafka_offset", "raw_envelope")


def classify(bronze: DataFrame, rules: Sequence[Rule] = ENVELOPE_RULES) -> DataFrame:
    """Decode bronze rows and label each with its failure codes and reason.

    One narrow pass. ``failure_reason`` is null exactly for valid rows; nothing is
    dropped, so valid and quarantined rows add up to the input.
    """
    codes = (
        f"CASE WHEN env_check.parsed THEN {failing_codes(DECODED, rules)} "
        f"ELSE array('{CODE_PARSE}') END"
    )
    reason = (
        f"CASE WHEN NOT env_check.parsed THEN '{REASON_PARSE}' "
        f"WHEN size(failure_codes) > 0 THEN '{REASON_RULES}' END AS failure_reason"
    )
    labelled = computed_once(decode(bronze), "failure_codes", codes)
    return labelled.selectExpr("*", reason).drop("env_check")


def to_dlq(failing: DataFrame, reason: str | None = None) -> DataFrame:
    """Project failing rows onto the quarantine columns, with a content key.

    ``reason`` overrides the rows' own ``failure_reason``.
    """
    own = {
        "dlq_key": f"{content_key(_KEY_PARTS)} AS dlq_key",
        "failure_reason": "failure_reason" if reason is None else f"'{reason}' AS failure_reason",
        "ingest_day": f"{utc_day('ingest_ts')} AS ingest_day",
    }
    return failing.selectExpr(*[own.get(c, c) for c in DLQ_COLUMNS])


def split_classified(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine rows of both reasons)."""
    return (
        classified.filter("failure_reason IS NULL"),
        to_dlq(classified.filter("failure_reason IS NOT NULL")),
    )


def union_failures(broken: DataFrame, unparsed: DataFrame) -> DataFrame:
    """Rule failures and unparseable rows, split earlier, as one quarantine frame."""
    unparsed = unparsed.selectExpr("*", f"array('{CODE_PARSE}') AS failure_codes")
    return to_dlq(broken, REASON_RULES).unionByName(to_dlq(unparsed, REASON_PARSE))


def replay_dlq(dlq: DataFrame, rules: Sequence[Rule] = ENVELOPE_RULES) -> DataFrame:
    """Decode and check quarantined text again under the rules of today.

    Rows that pass now have a null ``failure_reason`` and carry ``env``, ready for
    :func:`tidemark.operators.silver.latest_observations`.
    """
    return classify(dlq.drop("failure_reason", "failure_codes", "ingest_day"), rules)
