"""Apply a rule table to a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.barrier import computed_once
from tidemark.functions.rules import (
    ENVELOPE_RULES,
    Record,
    Rule,
    failing_codes,
    failing_details,
    summarize,
)
from tidemark.operators.decode import DECODED


def annotate_failures(
    df: DataFrame, rules: Sequence[Rule] = ENVELOPE_RULES, record: Record = DECODED
) -> DataFrame:
    """Add ``failure_codes``: every broken rule's code, empty for a valid row."""
    return computed_once(df, "failure_codes", failing_codes(record, rules))


def failure_details(
    df: DataFrame, rules: Sequence[Rule] = ENVELOPE_RULES, record: Record = DECODED
) -> DataFrame:
    """Add ``failures``: code, field and message of every failure."""
    return computed_once(df, "failures", failing_details(record, rules))


def failure_summary(df: DataFrame, column: str = "failures") -> DataFrame:
    """Add ``failure_summary``, one line per row."""
    return df.selectExpr("*", f"{summarize(column)} AS failure_summary")


def split_valid(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with no failure, rows with at least one)."""
    return (
        annotated.filter("size(failure_codes) = 0"),
        annotated.filter("size(failure_codes) > 0"),
    )
