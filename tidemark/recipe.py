"""Derive bronze rows and search-response pages from the ``events`` table.

Test inputs only. Every event becomes one listing observation (every 50th is
redelivered), with defects that are fixed by arithmetic on its id, so that plain
SQL over ``events`` can state each expected result without parsing JSON. The
whole table is used; the remainders choose what is wrong with a row, not which
rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.times import utc_instant

TODAY = "2024-01-30"

_OBSERVED_AT = """CASE WHEN event_id % 89 = 0 THEN 'garbage' ELSE
    concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00') END"""
_RATING = """CASE WHEN event_id % 53 = 0 THEN 9.9D WHEN event_id % 59 = 0 THEN NULL
    WHEN event_id % 61 = 0 THEN 4.2D ELSE 1.0D + (event_id % 9) * 0.5D END"""
_REVIEW_COUNT = "cast(CASE WHEN event_id % 67 = 0 THEN -1 ELSE floor(value) END AS int)"
_CATEGORIES = """CASE WHEN event_id % 71 = 0 THEN cast(array() AS array<string>)
    WHEN event_id % 2 = 0 THEN array(event_type)
    ELSE array(event_type, concat('k', event_id % 5)) END"""
_COORDINATES = """named_struct(
    'latitude', CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 100.0D
        ELSE cast(user_id % 181 - 90 AS double) END,
    'longitude', CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 173 = 0 THEN 200.0D
        ELSE cast((user_id * 7) % 361 - 180 AS double) END)"""
_CITY = "CASE WHEN event_id % 83 = 0 THEN ' ' ELSE concat('City ', user_id % 10) END"
_BUSINESS_ID = "concat('b', user_id)"
_NAME = "concat('Business ', user_id, ' v', event_id % 3)"
_AREA = "concat('Area ', user_id % 3)"
_URL = "concat('https://example.org/', user_id)"
_CLOSED = "event_id % 6 = 0"
_PRICE = "CASE WHEN event_id % 4 <> 0 THEN repeat('$', cast(event_id % 4 AS int)) END"
_STATE = "concat('S', user_id % 7)"
_ZIP_CODE = "lpad(cast(user_id % 1000 AS string), 5, '0')"

# Defects that only an envelope has: what a producer of today would not publish.
_SENT_ID = "CASE WHEN event_id % 151 = 0 THEN '' ELSE cast(event_id AS string) END"
_SENT_BUSINESS = f"CASE WHEN event_id % 157 = 0 THEN ' ' ELSE {_BUSINESS_ID} END"
_SENT_COUNT = f"CASE WHEN event_id % 163 <> 0 THEN {_REVIEW_COUNT} END"
_SENT_CATEGORIES = f"CASE WHEN event_id % 179 = 0 THEN array('', event_type, ' ') ELSE {_CATEGORIES} END"

_ENVELOPE = f"""named_struct(
    'event_id', {_SENT_ID}, 'producer_id', 'recipe', 'source', 'events',
    'source_endpoint', 'businesses/search', 'schema_version', 1,
    'observed_at', {_OBSERVED_AT}, 'ingest_lag_ms', 0,
    'payload', named_struct(
        'business_id', {_SENT_BUSINESS}, 'name', {_NAME}, 'url', {_URL}, 'is_closed', {_CLOSED},
        'rating', {_RATING}, 'review_count', {_SENT_COUNT}, 'price', {_PRICE},
        'categories', {_SENT_CATEGORIES}, 'coordinates', {_COORDINATES},
        'location', named_struct('city', {_CITY}, 'state', {_STATE}, 'country', 'US', 'zip_code', {_ZIP_CODE}),
        'search_term', 'restaurants', 'search_location', {_AREA}))"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, dealt out evenly: a file of few row groups is read by as few tasks, whatever follows."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").hint("rebalance")


def _mistyped(text: str) -> str:
    """Every 149th rating becomes text, every 167th review count a fraction."""
    for step, member, value in ((149, "rating", '"high"'), (167, "review_count", "7.5")):
        text = f"""CASE WHEN event_id % {step} = 0
            THEN regexp_replace({text}, '"{member}":-?[0-9.]+', '"{member}":{value}') ELSE {text} END"""
    return text


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table the recipe stands for."""
    deliveries = events(spark, sf_dir).selectExpr("*", f"to_json({_ENVELOPE}) AS sent").selectExpr(
        "*",
        f"""CASE WHEN event_id % 97 = 0 THEN concat('not json #', event_id)
            WHEN event_id % 137 = 0 THEN concat('{{"event_id":"', event_id, '"}}', '{{}}')
            WHEN event_id % 139 = 0 THEN concat('{{"event_id":"', event_id, '"}} more')
            ELSE {_mistyped("sent")} END AS raw_envelope""",
        "explode(CASE WHEN event_id % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    return deliveries.selectExpr(
        f"{utc_instant('ts')} + make_dt_interval(0, 0, 1 + copy) AS ingest_ts",
        "'events' AS kafka_topic",
        "cast(user_id % 6 AS int) AS kafka_partition",
        "event_id * 2L + copy AS kafka_offset",
        f"{_BUSINESS_ID} AS kafka_key",
        "raw_envelope",
    )


def _member(name: str, value: str) -> str:
    """``"name":value`` as JSON text; a null value leaves the member out."""
    return f"concat('\"{name}\":', {value})"


def _text(value: str) -> str:
    return f"concat('\"', {value}, '\"')"


# A raw listing body as a search response would carry it.
_LISTING_MEMBERS = (
    _member("id", f"CASE WHEN event_id % 101 <> 0 THEN {_text(_BUSINESS_ID)} END"),
    _member("name", f"""CASE WHEN event_id % 107 = 0 THEN 'null'
        WHEN event_id % 103 <> 0 THEN {_text(_NAME)} END"""),
    _member("rating", f"""coalesce(CASE
        WHEN event_id % 109 = 0 THEN {_text(f"cast({_RATING} AS string)")}
        WHEN event_id % 113 = 0 THEN '"great"' ELSE cast({_RATING} AS string) END, 'null')"""),
    _member("review_count", f"""concat({_REVIEW_COUNT}, CASE WHEN event_id % 127 = 0 THEN '.0'
        WHEN event_id % 131 = 0 THEN '.5' ELSE '' END)"""),
    _member("is_closed", f"cast({_CLOSED} AS string)"),
    _member("url", _text(_URL)),
    _member("image_url", "'null'"),
    _member("price", f"coalesce({_text(_PRICE)}, 'null')"),
    _member("phone", _text("concat('+1', user_id)")),
    _member("distance", "cast(value AS string)"),
    _member("categories", f"""to_json(transform({_CATEGORIES},
        c -> named_struct('alias', c, 'title', upper(c))))"""),
    _member("coordinates", f"""CASE WHEN event_id % 79 = 0 THEN 'null'
        ELSE to_json({_COORDINATES}) END"""),
    _member("location", f"""to_json(named_struct('address1', concat(user_id, ' Main'), 'city', {_CITY},
        'state', {_STATE}, 'country', 'US', 'zip_code', {_ZIP_CODE}))"""),
    _member("transactions", """CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '["pickup"]' END"""),
)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search-response page per event: one listing, two, none, no array, or a broken page."""
    listing = f"concat('{{', concat_ws(',', {', '.join(_LISTING_MEMBERS)}), '}}')"
    return (
        events(spark, sf_dir)
        .selectExpr("*", f"{listing} AS listing")
        .selectExpr(
            """CASE WHEN event_id % 17 = 0 THEN element_at(array('page not found',
                    '{"total":1,"businesses":[{"id":"b', '{"total":1,"businesses":"none"}'),
                    cast(event_id % 3 + 1 AS int))
                WHEN event_id % 11 = 0 THEN '{"total":0,"businesses":[]}'
                WHEN event_id % 13 = 0 THEN '{"total":0}'
                WHEN event_id % 7 = 0 THEN
                    concat('{"total":2,"businesses":[', listing, ',', listing, ']}')
                ELSE concat('{"total":1,"businesses":[', listing, ']}') END AS body""",
            "CASE WHEN event_id % 2 = 0 THEN 'restaurants' ELSE 'bars' END AS search_term",
            f"{_AREA} AS search_location",
            f"{utc_instant('ts')} AS fetched_at",
            "event_id AS page_no",
        )
    )
