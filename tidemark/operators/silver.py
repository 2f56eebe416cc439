"""Valid envelopes to typed observations, one row per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import utc_day
from tidemark.schemas import SILVER_COLUMNS

# Silver columns that do not come from the payload's top level.
_ELSEWHERE = {
    "latitude": "env.payload.coordinates.latitude",
    "longitude": "env.payload.coordinates.longitude",
    "city": "env.payload.location.city",
    "state": "env.payload.location.state",
    "country": "env.payload.location.country",
    "zip_code": "env.payload.location.zip_code",
    "observed_at": "observed_at",
    "ingest_ts": "ingest_ts",
    "event_id": "env.event_id",
    "producer_id": "env.producer_id",
    "schema_version": "env.schema_version",
}


def to_silver(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten decoded envelopes to the silver columns, in table order."""
    flat = [f"{_ELSEWHERE.get(c, f'env.payload.{c}')} AS {c}" for c in SILVER_COLUMNS]
    return decoded.selectExpr(*flat, *keep)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key under ``order`` (SQL sort terms).

    One shuffle on the keys. The rank filter also runs before it, so a key that
    owns a large share of the rows sends one row per input partition.
    """
    rank = (
        f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    )
    return df.selectExpr("*", f"{rank} AS _rank").filter("_rank = 1").drop("_rank")


# What ranking deliveries of one event needs besides the silver columns.
DELIVERY = ("kafka_offset", "xxhash64(raw_envelope) AS _content")


def latest_observations(valid: DataFrame) -> DataFrame:
    """Silver rows of a batch: latest arrival, then highest offset, then content."""
    return latest_delivery(to_silver(valid, keep=DELIVERY))


def latest_delivery(flat: DataFrame) -> DataFrame:
    """One silver row per event out of rows that carry the ``DELIVERY`` columns."""
    order = ["ingest_ts DESC", "kafka_offset DESC", "_content DESC"]
    return dedup_latest(flat, ["event_id"], order).select(*SILVER_COLUMNS)


def with_day(df: DataFrame, instant: str = "observed_at") -> DataFrame:
    """Add the UTC observation day, whatever the session time zone is."""
    return df.withColumn("day", F.expr(utc_day(instant)))
