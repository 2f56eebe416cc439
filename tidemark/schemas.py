"""Every schema and table layout, declared once as Spark DDL.

Column and field names are fixed values: they are the wire and table contract.
"""

from __future__ import annotations

from dataclasses import dataclass

SCHEMA_VERSION = 1
RAW_TOPIC_FILES = "file://volume"

COORDINATES = "struct<latitude:double,longitude:double>"
LOCATION = "struct<address1:string,city:string,state:string,country:string,zip_code:string>"
PAYLOAD = (
    "struct<business_id:string,name:string,url:string,image_url:string,"
    "is_closed:boolean,rating:double,review_count:int,price:string,phone:string,"
    f"categories:array<string>,coordinates:{COORDINATES},location:{LOCATION},"
    "transactions:array<string>,search_term:string,search_location:string>"
)
ENVELOPE = (
    "event_id string, producer_id string, source string, source_endpoint string, "
    "schema_version int, observed_at string, ingest_lag_ms bigint, "
    f"payload {PAYLOAD}"
)
FAILURES = "array<struct<code:string,field:string,message:string>>"

# One search-response body; listings stay JSON text until they are normalised.
PAGE = "businesses array<string>"
# A listing whose members all have their proper JSON types.
LISTING = (
    "id string, name string, url string, image_url string, is_closed boolean, "
    "rating double, review_count int, price string, phone string, "
    f"categories array<struct<alias:string>>, coordinates {COORDINATES}, "
    f"location {LOCATION}, transactions array<string>"
)


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and physical partitioning of one table."""

    schema_name: str
    name: str
    columns: str
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    # Columns rows are clustered on inside a partition; serves file pruning.
    cluster_by: tuple[str, ...] = ()
    # The partition column that holds the UTC day of an instant, and that instant.
    day_of: tuple[str, str] = ("day", "observed_at")
    # Columns that are never null.
    required: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.schema_name}.{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [column.split()[0] for column in self.columns.split(", ")]


# `ingest_day` is the UTC day of `ingest_ts`; `batch` names the micro-batch that landed the row.
BRONZE = TableSpec(
    "bronze",
    "business_events_raw",
    "ingest_ts timestamp, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_key string, raw_envelope string, ingest_day date, batch string",
    partition_by=("kafka_topic", "ingest_day", "batch"),
    cluster_by=("kafka_partition", "kafka_offset"),
    day_of=("ingest_day", "ingest_ts"),
)

SILVER_COLUMNS = (
    "business_id", "name", "rating", "review_count", "price", "is_closed", "url",
    "categories", "latitude", "longitude", "city", "state", "country", "zip_code",
    "search_term", "search_location", "observed_at", "ingest_ts", "event_id",
    "producer_id", "schema_version",
)
# `day` is the UTC observation day: the physical partition of the parquet form.
SILVER = TableSpec(
    "silver",
    "business_events",
    "business_id string, name string, rating double, review_count int, price string, "
    "is_closed boolean, url string, categories array<string>, latitude double, "
    "longitude double, city string, state string, country string, zip_code string, "
    "search_term string, search_location string, observed_at timestamp, "
    "ingest_ts timestamp, event_id string, producer_id string, schema_version int, "
    "day date",
    partition_by=("day",),
    keys=("event_id",),
    cluster_by=("business_id", "observed_at"),
    required=("business_id",),
)

DLQ_COLUMNS = (
    "dlq_key", "ingest_ts", "kafka_topic", "kafka_partition", "kafka_offset",
    "kafka_key", "failure_reason", "failure_codes", "raw_envelope", "ingest_day",
)
DLQ = TableSpec(
    "dlq",
    "business",
    "dlq_key string, ingest_ts timestamp, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_key string, failure_reason string, "
    "failure_codes array<string>, raw_envelope string, ingest_day date",
    partition_by=("failure_reason", "ingest_day"),
    keys=("dlq_key",),
    required=("dlq_key",),
    cluster_by=("kafka_topic", "kafka_offset", "dlq_key"),
    day_of=("ingest_day", "ingest_ts"),
)

RATING_DRIFT = TableSpec(
    "gold",
    "rating_drift_daily",
    "day date, business_id string, name string, city string, rating_avg double, "
    "rating_min double, rating_max double, review_count_max int, observations int",
    partition_by=("day",),
    keys=("day", "business_id"),
    cluster_by=("business_id",),
)

CATEGORY_TRENDS = TableSpec(
    "gold",
    "category_trends_daily",
    "day date, category string, city string, total_observations bigint, "
    "distinct_businesses bigint, avg_rating double",
    partition_by=("day",),
    keys=("day", "category", "city"),
    cluster_by=("category", "city"),
)

ALL_TABLES = (BRONZE, SILVER, DLQ, RATING_DRIFT, CATEGORY_TRENDS)
