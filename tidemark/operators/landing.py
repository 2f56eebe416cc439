"""Source records to bronze rows: lineage plus the text, nothing parsed away."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.schemas import RAW_TOPIC_FILES


def to_bronze_kafka(records: DataFrame, ingest_ts: str = "current_timestamp()") -> DataFrame:
    """Kafka records to bronze rows."""
    return records.selectExpr(
        f"{ingest_ts} AS ingest_ts",
        "topic AS kafka_topic",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
        "cast(key AS string) AS kafka_key",
        "cast(value AS string) AS raw_envelope",
    )


def to_bronze_files(lines: DataFrame, ingest_ts: str = "current_timestamp()") -> DataFrame:
    """Lines of dropped files to bronze rows; files have no offsets to record."""
    return lines.selectExpr(
        f"{ingest_ts} AS ingest_ts",
        f"'{RAW_TOPIC_FILES}' AS kafka_topic",
        "0 AS kafka_partition",
        "-1L AS kafka_offset",
        "coalesce(get_json_object(value, '$.payload.business_id'), '') AS kafka_key",
        "value AS raw_envelope",
    )
