"""Operational queries over the tables.

Dates come from a ``today`` argument. Every limit sorts on a full tie-break, so a
top-k is one ``TakeOrderedAndProject`` with a stable result.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DRIFT = ("day", "business_id", "name", "city", "rating_avg", "rating_min", "rating_max",
          "observations")


def _last_days(df: DataFrame, today: dt.date, days: int) -> DataFrame:
    return df.filter(F.col("day") >= F.lit(today - dt.timedelta(days=days)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one result."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dlq_by_reason_code(dlq: DataFrame) -> DataFrame:
    """Quarantine failures per reason and code, most frequent first."""
    return (
        dlq.select("failure_reason", F.explode("failure_codes").alias("failure_code"))
        .groupBy("failure_reason", "failure_code")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "failure_reason", "failure_code")
    )


def dlq_by_code(dlq: DataFrame) -> DataFrame:
    """Quarantine failures per code, most frequent first."""
    return (
        dlq.select(F.explode("failure_codes").alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "code")
    )


def drift_recent(drift: DataFrame, today: dt.date, days: int = 7, limit: int = 50) -> DataFrame:
    """The most observed (day, business) rows of the last days."""
    return (
        _last_days(drift, today, days)
        .orderBy(F.desc("observations"), "day", "business_id")
        .limit(limit)
        .select(*_DRIFT)
    )


def trending_rollup(trends: DataFrame, today: dt.date, days: int = 7, limit: int = 25) -> DataFrame:
    """Categories per city over the last days.

    Daily distinct counts do not add up to a distinct count; the sum says so in its
    name.
    """
    return (
        _last_days(trends, today, days)
        .groupBy("category", "city")
        .agg(
            F.sum("total_observations").alias("observations"),
            F.sum("distinct_businesses").alias("distinct_businesses_sum"),
        )
        .orderBy(F.desc("observations"), "category", "city")
        .limit(limit)
    )


def trending_top(trends: DataFrame, today: dt.date, days: int = 7, limit: int = 25) -> DataFrame:
    """The largest daily (category, city) rows of the last days."""
    return (
        _last_days(trends, today, days)
        .orderBy(F.desc("total_observations"), "day", "category", "city")
        .limit(limit)
        .select("category", "city", "total_observations", "distinct_businesses")
    )


def latest_silver(silver: DataFrame, limit: int = 10) -> DataFrame:
    """The latest observations."""
    return (
        silver.orderBy(F.desc("observed_at"), "event_id")
        .limit(limit)
        .select("business_id", "name", "city", "rating", "review_count", "observed_at")
    )


def business_history(drift: DataFrame, business_id: str, limit: int = 14) -> DataFrame:
    """The latest days of one business."""
    return (
        drift.filter(F.col("business_id") == business_id)
        .orderBy(F.desc("day"))
        .limit(limit)
        .select("day", "rating_avg", "rating_min", "rating_max", "observations")
    )


def bronze_freshness(bronze: DataFrame) -> DataFrame:
    """Rows landed and the latest arrival."""
    return bronze.agg(
        F.count(F.lit(1)).alias("rows"), F.max("ingest_ts").alias("latest_ingest_ts")
    )


def log_volume(bronze: DataFrame) -> DataFrame:
    """Sum of end offsets over the partitions of each topic."""
    return (
        bronze.groupBy("kafka_topic", "kafka_partition")
        .agg((F.max("kafka_offset") + 1).alias("end_offset"))
        .groupBy("kafka_topic")
        .agg(F.sum("end_offset").alias("offset_sum"))
    )


def log_head(bronze: DataFrame, topic: str, limit: int = 20) -> DataFrame:
    """The first records of a topic as ``key | value``."""
    return (
        bronze.filter(F.col("kafka_topic") == topic)
        .orderBy("kafka_partition", "kafka_offset")
        .limit(limit)
        .select(F.concat_ws(" | ", "kafka_key", "raw_envelope").alias("record"))
    )
