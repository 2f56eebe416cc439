"""The result of each query, stated in SQL from the given tables alone.

Nothing here parses JSON or shares code with the Spark side: the recipe's defects
are arithmetic on ``event_id``, so the expected rows follow from it.
"""

from __future__ import annotations

# One row per delivery with the values its envelope carries.
_DELIVERIES = """
WITH deliveries AS (
  SELECT event_id AS id, ts, user_id, event_type, value, 0 AS copy FROM events
  UNION ALL
  SELECT event_id AS id, ts, user_id, event_type, value, 1 AS copy FROM events
  WHERE event_id % 50 = 0
),
typed AS (
  SELECT id, copy, ts,
    id % 97 <> 0 AND id % 137 <> 0 AND id % 139 <> 0 AS parsed,
    CASE WHEN id % 151 = 0 THEN '' ELSE CAST(id AS VARCHAR) END AS event_id,
    CASE WHEN id % 157 = 0 THEN ' ' ELSE 'b' || user_id END AS business_id,
    'Business ' || user_id || ' v' || (id % 3) AS name,
    CAST(CASE WHEN id % 53 = 0 THEN 9.9 WHEN id % 59 = 0 THEN NULL
              WHEN id % 61 = 0 THEN 4.2 ELSE 1.0 + (id % 9) * 0.5 END AS DOUBLE) AS sent_rating,
    id % 149 = 0 AND sent_rating IS NOT NULL AS odd_rating,
    CASE WHEN NOT odd_rating THEN sent_rating END AS rating,
    CASE WHEN id % 163 = 0 THEN NULL WHEN id % 67 = 0 THEN -1
         ELSE CAST(floor(value) AS INTEGER) END AS sent_count,
    id % 167 = 0 AND sent_count IS NOT NULL AS odd_count,
    CASE WHEN NOT odd_count THEN sent_count END AS review_count,
    CASE WHEN id % 179 = 0 THEN ['', event_type, ' ']
         WHEN id % 71 = 0 THEN CAST([] AS VARCHAR[]) WHEN id % 2 = 0 THEN [event_type]
         ELSE [event_type, 'k' || (id % 5)] END AS categories,
    CASE WHEN id % 79 <> 0 THEN CAST(CASE WHEN id % 73 = 0 THEN 100
         ELSE user_id % 181 - 90 END AS DOUBLE) END AS latitude,
    CASE WHEN id % 79 <> 0 THEN CAST(CASE WHEN id % 173 = 0 THEN 200
         ELSE (user_id * 7) % 361 - 180 END AS DOUBLE) END AS longitude,
    CASE WHEN id % 83 = 0 THEN ' ' ELSE 'City ' || (user_id % 10) END AS city,
    'https://example.org/' || user_id AS url, id % 6 = 0 AS is_closed,
    CASE WHEN id % 4 <> 0 THEN repeat('$', CAST(id % 4 AS INTEGER)) END AS price,
    'S' || (user_id % 7) AS state, lpad(CAST(user_id % 1000 AS VARCHAR), 5, '0') AS zip_code,
    'US' AS country, 'restaurants' AS search_term,
    'Area ' || (user_id % 3) AS search_location,
    'recipe' AS producer_id, CAST(1 AS INTEGER) AS schema_version,
    CASE WHEN id % 89 <> 0 THEN ts END AS observed_at,
    CASE WHEN id % 89 = 0 THEN 'garbage'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS observed_text,
    'events' AS kafka_topic, CAST(user_id % 6 AS INTEGER) AS kafka_partition,
    CAST(id * 2 + copy AS BIGINT) AS kafka_offset, 'b' || user_id AS kafka_key,
    ts + INTERVAL (1 + copy) MINUTE AS ingest_ts
  FROM deliveries
),
texts AS (
  SELECT *,
    CASE WHEN id % 97 = 0 THEN 'not json #' || id
      WHEN id % 137 = 0 THEN '{"event_id":"' || id || '"}{}'
      WHEN id % 139 = 0 THEN '{"event_id":"' || id || '"} more' ELSE
      '{"event_id":"' || event_id || '","producer_id":"recipe","source":"events",'
      || '"source_endpoint":"businesses/search","schema_version":1,"observed_at":"'
      || observed_text || '","ingest_lag_ms":0,"payload":{"business_id":"' || business_id
      || '","name":"' || name || '","url":"' || url || '","is_closed":' || is_closed || ','
      || CASE WHEN odd_rating THEN '"rating":"high",' WHEN rating IS NULL THEN ''
         ELSE '"rating":' || rating || ',' END
      || CASE WHEN odd_count THEN '"review_count":7.5,' WHEN review_count IS NULL THEN ''
         ELSE '"review_count":' || review_count || ',' END
      || CASE WHEN price IS NULL THEN '' ELSE '"price":"' || price || '",' END || '"categories":['
      || array_to_string(list_transform(categories, lambda c: '"' || c || '"'), ',')
      || '],"coordinates":{' || CASE WHEN latitude IS NULL THEN '' ELSE
           '"latitude":' || latitude || ',"longitude":' || longitude END
      || '},"location":{"city":"' || city || '","state":"' || state || '","country":"US","zip_code":"'
      || zip_code || '"},'
      || '"search_term":"restaurants","search_location":"' || search_location || '"}}'
    END AS raw_envelope
  FROM typed
),
failures AS (
  SELECT *, CASE WHEN NOT parsed THEN [] ELSE list_filter([
    CASE WHEN event_id = '' THEN {'code': 'missing_event_id', 'field': 'event_id',
      'message': 'event_id must be a non-empty string'} END,
    CASE WHEN observed_at IS NULL THEN {'code': 'missing_observed_at', 'field': 'observed_at',
      'message': 'observed_at must be a timestamp'} END,
    CASE WHEN trim(business_id) = '' THEN {'code': 'missing_business_id', 'field': 'business_id',
      'message': 'business_id must be a non-empty string'} END,
    CASE WHEN rating IS NULL AND NOT odd_rating THEN {'code': 'missing_rating', 'field': 'rating',
      'message': 'rating is required'} END,
    CASE WHEN odd_rating THEN {'code': 'bad_rating_type', 'field': 'rating',
      'message': 'rating must be numeric, got str'} END,
    CASE WHEN rating IN (9.9, 4.2) THEN {'code': 'rating_out_of_range', 'field': 'rating',
      'message': 'rating=' || rating || ' outside 1.0..5.0 in 0.5 increments'} END,
    CASE WHEN review_count IS NULL AND NOT odd_count THEN {'code': 'missing_review_count',
      'field': 'review_count', 'message': 'review_count is required'} END,
    CASE WHEN odd_count THEN {'code': 'bad_review_count_type', 'field': 'review_count',
      'message': 'review_count must be an integer'} END,
    CASE WHEN review_count < 0 THEN {'code': 'negative_review_count', 'field': 'review_count',
      'message': 'review_count=' || review_count || ' is negative'} END,
    CASE WHEN latitude IS NULL THEN {'code': 'missing_coordinates', 'field': 'coordinates',
      'message': 'coordinates.latitude and coordinates.longitude required'} END,
    CASE WHEN latitude > 90 THEN {'code': 'latitude_out_of_range',
      'field': 'coordinates.latitude',
      'message': 'latitude=' || latitude || ' not in [-90, 90]'} END,
    CASE WHEN longitude > 180 THEN {'code': 'longitude_out_of_range',
      'field': 'coordinates.longitude',
      'message': 'longitude=' || longitude || ' not in [-180, 180]'} END,
    CASE WHEN trim(city) = '' THEN {'code': 'missing_city', 'field': 'location.city',
      'message': 'location.city must be a non-empty string'} END,
    CASE WHEN len(categories) = 0 THEN {'code': 'missing_categories', 'field': 'categories',
      'message': 'categories must be a non-empty list'} END,
    CASE WHEN id % 179 = 0 THEN {'code': 'bad_category_value', 'field': 'categories[0]',
      'message': 'each category must be a non-empty string'} END,
    CASE WHEN id % 179 = 0 THEN {'code': 'bad_category_value', 'field': 'categories[2]',
      'message': 'each category must be a non-empty string'} END
  ], lambda f: f IS NOT NULL) END AS failing
  FROM texts
),
labelled AS (
  SELECT *, CASE WHEN NOT parsed THEN ['unparseable_envelope']
      ELSE list_transform(list_filter(failing, lambda f: f.field <> 'categories[2]'),
        lambda f: f.code) END AS codes,
    CASE WHEN NOT parsed THEN 'envelope_parse_failed'
         WHEN len(failing) > 0 THEN 'silver_validation' END AS failure_reason
  FROM failures
),
silver AS (
  SELECT *, CAST(observed_at AS DATE) AS day FROM labelled
  WHERE failure_reason IS NULL
  QUALIFY row_number() OVER (
    PARTITION BY event_id ORDER BY ingest_ts DESC, kafka_offset DESC) = 1
),
drift AS (
  SELECT day, business_id, arg_max(name, observed_at) AS name,
    arg_max(city, observed_at) AS city, round(avg(rating), 6) AS rating_avg,
    min(rating) AS rating_min, max(rating) AS rating_max,
    max(review_count) AS review_count_max, CAST(count(*) AS INTEGER) AS observations
  FROM silver GROUP BY day, business_id
),
tagged AS (SELECT *, unnest(categories) AS category FROM silver),
trends AS (
  SELECT day, category, city, count(*) AS total_observations,
    count(DISTINCT business_id) AS distinct_businesses, round(avg(rating), 6) AS avg_rating
  FROM tagged GROUP BY day, category, city
),
dlq AS (
  SELECT sha256(concat_ws('§', kafka_topic, kafka_partition, kafka_offset, raw_envelope))
      AS dlq_key, *
  FROM labelled WHERE failure_reason IS NOT NULL
)
"""

_SILVER = """event_id, business_id, name, rating, review_count,
  array_to_string(categories, '|') AS categories, latitude, longitude, city, country,
  search_term, search_location, producer_id, schema_version, observed_at,
  url, is_closed, price, state, zip_code"""
_ALL_SILVER = f"SELECT {_SILVER}, ingest_ts FROM silver"
_DLQ = """SELECT dlq_key, kafka_topic, kafka_partition, kafka_offset, kafka_key,
  failure_reason, array_to_string(codes, '|') AS failure_codes, raw_envelope, ingest_ts
  FROM dlq"""

# One row per listing on a page, with the values its body carries.
_LISTINGS = """
WITH pages_of_events AS (
  SELECT event_id AS id, ts, user_id, event_type, value,
    CASE WHEN event_id % 2 = 0 THEN 'restaurants' ELSE 'bars' END AS search_term,
    'Area ' || (user_id % 3) AS search_location,
    CASE WHEN event_id % 17 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN 0
         WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS size
  FROM events
),
typed AS (
  SELECT id, ts, search_term, search_location, size,
    'b' || user_id AS business_id,
    CASE WHEN id % 103 <> 0 THEN 'Business ' || user_id || ' v' || (id % 3) END AS full_name,
    CAST(CASE WHEN id % 53 = 0 THEN 9.9 WHEN id % 59 = 0 THEN NULL
              WHEN id % 61 = 0 THEN 4.2 ELSE 1.0 + (id % 9) * 0.5 END AS DOUBLE) AS number,
    CASE WHEN id % 67 = 0 THEN -1 ELSE CAST(floor(value) AS INTEGER) END AS review_count,
    CASE WHEN id % 71 = 0 THEN CAST([] AS VARCHAR[]) WHEN id % 2 = 0 THEN [event_type]
         ELSE [event_type, 'k' || (id % 5)] END AS categories,
    CASE WHEN id % 79 <> 0 THEN CAST(CASE WHEN id % 73 = 0 THEN 100
         ELSE user_id % 181 - 90 END AS DOUBLE) END AS latitude,
    CASE WHEN id % 79 <> 0 THEN CAST(CASE WHEN id % 173 = 0 THEN 200
         ELSE (user_id * 7) % 361 - 180 END AS DOUBLE) END AS longitude,
    CASE WHEN id % 83 = 0 THEN ' ' ELSE 'City ' || (user_id % 10) END AS city,
    'https://example.org/' || user_id AS url, id % 6 = 0 AS is_closed, '+1' || user_id AS phone,
    CASE WHEN id % 4 <> 0 THEN repeat('$', CAST(id % 4 AS INTEGER)) END AS price,
    user_id || ' Main' AS address1, 'S' || (user_id % 7) AS state,
    lpad(CAST(user_id % 1000 AS VARCHAR), 5, '0') AS zip_code,
    value
  FROM pages_of_events
),
judged AS (
  SELECT *,
    CASE WHEN id % 107 = 0 THEN NULL ELSE coalesce(full_name, '') END AS name,
    CASE WHEN id % 109 = 0 THEN number WHEN id % 113 = 0 THEN NULL ELSE number END AS rating,
    id % 101 = 0 OR id % 107 = 0 OR (id % 113 = 0 AND id % 109 <> 0)
      OR (id % 131 = 0 AND id % 127 <> 0) AS failed,
    '{' || concat_ws(',',
      CASE WHEN id % 101 <> 0 THEN '"id":"' || business_id || '"' END,
      CASE WHEN id % 107 = 0 THEN '"name":null'
           WHEN full_name IS NOT NULL THEN '"name":"' || full_name || '"' END,
      '"rating":' || coalesce(CASE WHEN id % 109 = 0 THEN '"' || number || '"'
           WHEN id % 113 = 0 THEN '"great"' ELSE CAST(number AS VARCHAR) END, 'null'),
      '"review_count":' || review_count || CASE WHEN id % 127 = 0 THEN '.0'
           WHEN id % 131 = 0 THEN '.5' ELSE '' END,
      '"is_closed":' || is_closed, '"url":"' || url || '"', '"image_url":null',
      '"price":' || coalesce('"' || price || '"', 'null'), '"phone":"' || phone || '"',
      '"distance":' || value,
      '"categories":[' || array_to_string(list_transform(categories,
           lambda c: '{"alias":"' || c || '","title":"' || upper(c) || '"}'), ',') || ']',
      '"coordinates":' || CASE WHEN id % 79 = 0 THEN 'null' ELSE
           '{"latitude":' || latitude || ',"longitude":' || longitude || '}' END,
      '"location":{"address1":"' || address1 || '","city":"' || city || '","state":"' || state
           || '","country":"US","zip_code":"' || zip_code || '"}',
      '"transactions":' || CASE WHEN id % 5 = 0 THEN 'null' ELSE '["pickup"]' END
    ) || '}' AS listing
  FROM typed
),
placed AS (
  SELECT *, id AS page_no, CAST(unnest(range(size)) AS INTEGER) AS position FROM judged
),
listings AS (
  SELECT *, list_filter([
    CASE WHEN name = '' THEN {'code': 'missing_name', 'field': 'name',
      'message': 'name must be a non-empty string'} END,
    CASE WHEN rating IS NULL THEN {'code': 'missing_rating', 'field': 'rating',
      'message': 'rating is required'} END,
    CASE WHEN rating IN (9.9, 4.2) THEN {'code': 'rating_out_of_range', 'field': 'rating',
      'message': 'rating=' || rating || ' outside 1.0..5.0 in 0.5 increments'} END,
    CASE WHEN review_count < 0 THEN {'code': 'negative_review_count', 'field': 'review_count',
      'message': 'review_count=' || review_count || ' is negative'} END,
    CASE WHEN latitude IS NULL THEN {'code': 'missing_coordinates', 'field': 'coordinates',
      'message': 'coordinates.latitude and coordinates.longitude required'} END,
    CASE WHEN latitude > 90 THEN {'code': 'latitude_out_of_range', 'field': 'coordinates.latitude',
      'message': 'latitude=' || latitude || ' not in [-90, 90]'} END,
    CASE WHEN longitude > 180 THEN {'code': 'longitude_out_of_range',
      'field': 'coordinates.longitude', 'message': 'longitude=' || longitude || ' not in [-180, 180]'} END,
    CASE WHEN trim(city) = '' THEN {'code': 'missing_city', 'field': 'location.city',
      'message': 'location.city must be a non-empty string'} END,
    CASE WHEN len(categories) = 0 THEN {'code': 'missing_categories', 'field': 'categories',
      'message': 'categories must be a non-empty list'} END
  ], lambda f: f IS NOT NULL) AS failing,
  list_transform(failing, lambda f: f.code) AS codes,
  '{"business_id":"' || business_id || '","name":"' || name || '","url":"' || url || '","image_url":null,"is_closed":'
    || is_closed || ',"rating":' || coalesce(CAST(rating AS VARCHAR), 'null') || ',"review_count":' || review_count
    || ',"price":' || coalesce('"' || price || '"', 'null') || ',"phone":"' || phone || '","categories":['
    || array_to_string(list_transform(categories, lambda c: '"' || c || '"'), ',') || '],"coordinates":{"latitude":'
    || coalesce(CAST(latitude AS VARCHAR), 'null') || ',"longitude":' || coalesce(CAST(longitude AS VARCHAR), 'null')
    || '},"location":{"address1":"' || address1 || '","city":"' || city || '","state":"' || state
    || '","country":"US","zip_code":"' || zip_code || '"},"transactions":['
    || CASE WHEN id % 5 = 0 THEN '' ELSE '"pickup"' END || '],"search_term":"' || search_term
    || '","search_location":"' || search_location || '"}' AS payload_text,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS observed_text
  FROM placed
),
outcomes AS (
  SELECT *, CASE WHEN failed THEN 'normalize_failed'
    WHEN len(codes) > 0 THEN 'pre_publish_validation' END AS reason
  FROM listings
)
"""


def _from_deliveries(select: str) -> str:
    return _DELIVERIES + select


def _from_listings(select: str) -> str:
    return _LISTINGS + select


_DRIFT_COLUMNS = """day, business_id, name, city, rating_avg, rating_min, rating_max,
  observations"""

_DELIVERY_QUERIES = {
    "envelope_decode": """SELECT kafka_offset, event_id, business_id, name, rating,
        review_count, array_to_string(categories, '|') AS categories, latitude, longitude,
        city, observed_at FROM labelled WHERE parsed""",
    "envelope_unparseable": """SELECT kafka_key, kafka_offset, raw_envelope
        FROM labelled WHERE NOT parsed""",
    "failure_code_counts": """SELECT code, count(*) AS n FROM (
        SELECT unnest(codes) AS code FROM labelled WHERE parsed) GROUP BY code""",
    "failure_details_rows": """SELECT kafka_offset, f.code AS code, f.field AS field,
        f.message AS message FROM (
        SELECT kafka_offset, unnest(failing) AS f FROM failures WHERE parsed)""",
    "failure_summary_rows": """SELECT kafka_offset, coalesce(array_to_string(
        list_transform(failing, lambda f: f.code || ':' || f.field), ','), '')
        AS failure_summary FROM failures WHERE parsed""",
    "valid_invalid_split": """SELECT CASE WHEN NOT parsed THEN 'unparsed'
        WHEN failure_reason IS NULL THEN 'valid' ELSE 'invalid' END AS table_name,
        count(*) AS rows FROM labelled GROUP BY 1""",
    "silver_projection": f"""SELECT {_SILVER}, ingest_ts, kafka_offset FROM labelled
        WHERE failure_reason IS NULL""",
    "silver_dedup": _ALL_SILVER,
    "silver_upsert": _ALL_SILVER,
    "silver_replay": _ALL_SILVER,
    "dlq_rows": _DLQ,
    "dlq_union": _DLQ,
    "dlq_insert_absent": _DLQ,
    "dlq_replay": """SELECT kafka_offset, CASE WHEN NOT parsed THEN 'envelope_parse_failed'
        WHEN codes = ['rating_out_of_range'] THEN 'valid' ELSE 'silver_validation' END
        AS outcome, coalesce(array_to_string(list_filter(codes,
        lambda c: c <> 'rating_out_of_range'), '|'), '') AS failure_codes FROM dlq""",
    "kafka_landing": """SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key,
        raw_envelope FROM texts""",
    "bronze_drain": """SELECT 'file://volume' AS kafka_topic,
        CAST(0 AS INTEGER) AS kafka_partition, CAST(-1 AS BIGINT) AS kafka_offset,
        CASE WHEN parsed THEN business_id ELSE '' END AS kafka_key, raw_envelope
        FROM texts""",
    "stream_equals_batch": f"SELECT {_SILVER} FROM silver",
    "day_bucket": "SELECT day, count(*) AS n FROM silver GROUP BY day",
    "gold_window_scan": """SELECT event_id, business_id, day FROM silver
        WHERE day >= DATE '2024-01-29'""",
    "rating_drift": "SELECT * FROM drift",
    "rating_drift_window": "SELECT * FROM drift WHERE day >= DATE '2024-01-29'",
    "category_trends": "SELECT * FROM trends",
    "category_trends_window": "SELECT * FROM trends WHERE day >= DATE '2024-01-29'",
    "gold_replace_keeps_history": """SELECT * REPLACE (review_count_max +
        CASE WHEN day < DATE '2024-01-29' THEN 1000 ELSE 0 END AS review_count_max)
        FROM drift""",
    "gold_empty_window": "SELECT * FROM trends",
    "table_counts": """SELECT 'bronze.business_events_raw' AS table_name, count(*) AS rows
          FROM texts
        UNION ALL SELECT 'silver.business_events', count(*) FROM silver
        UNION ALL SELECT 'gold.rating_drift_daily', count(*) FROM drift
        UNION ALL SELECT 'gold.category_trends_daily', count(*) FROM trends
        UNION ALL SELECT 'dlq.business', count(*) FROM dlq""",
    "dlq_by_reason_code": """SELECT failure_reason, failure_code, count(*) AS n FROM (
        SELECT failure_reason, unnest(codes) AS failure_code FROM dlq)
        GROUP BY failure_reason, failure_code""",
    "dlq_by_code": """SELECT code, count(*) AS n FROM (
        SELECT unnest(codes) AS code FROM dlq) GROUP BY code""",
    "drift_recent": f"""SELECT {_DRIFT_COLUMNS} FROM drift WHERE day >= DATE '2024-01-23'
        ORDER BY observations DESC, day, business_id LIMIT 50""",
    "trending_rollup": """SELECT category, city,
        CAST(sum(total_observations) AS BIGINT) AS observations,
        CAST(sum(distinct_businesses) AS BIGINT) AS distinct_businesses_sum
        FROM trends WHERE day >= DATE '2024-01-23' GROUP BY category, city
        ORDER BY observations DESC, category, city LIMIT 25""",
    "trending_top": """SELECT category, city, total_observations, distinct_businesses
        FROM trends WHERE day >= DATE '2024-01-23'
        ORDER BY total_observations DESC, day, category, city LIMIT 25""",
    "latest_observations_top": """SELECT business_id, name, city, rating, review_count,
        observed_at FROM silver ORDER BY observed_at DESC, event_id LIMIT 10""",
    "business_history": """SELECT day, rating_avg, rating_min, rating_max, observations
        FROM drift WHERE business_id = 'b8' ORDER BY day DESC LIMIT 14""",
    "bronze_freshness": """SELECT count(*) AS rows, max(ingest_ts) AS latest_ingest_ts
        FROM texts""",
    "log_volume": """SELECT kafka_topic, CAST(sum(end_offset) AS BIGINT) AS offset_sum FROM (
        SELECT kafka_topic, kafka_partition, max(kafka_offset) + 1 AS end_offset
        FROM texts GROUP BY kafka_topic, kafka_partition) GROUP BY kafka_topic""",
    "log_tail": """SELECT kafka_key || ' | ' || raw_envelope AS record FROM texts
        WHERE kafka_topic = 'events' ORDER BY kafka_partition, kafka_offset LIMIT 20""",
    "retention_prune": f"""{_ALL_SILVER}
        WHERE observed_at >= TIMESTAMP '2024-01-20 12:00:00'""",
    "compaction_same_rows": _ALL_SILVER,
    "compaction_files": """SELECT day, count(*) AS n, TRUE AS few_files, FALSE AS rewritten_again
        FROM silver GROUP BY day""",
    "run_reports": """SELECT 'bronze_rows' AS report, count(*) AS rows FROM texts
        UNION ALL SELECT 'valid', count(*) FROM labelled WHERE failure_reason IS NULL
        UNION ALL SELECT 'dlq', count(*) FROM labelled WHERE failure_reason IS NOT NULL
        UNION ALL SELECT 'unparseable', count(*) FROM labelled WHERE NOT parsed
        UNION ALL SELECT 'drift_rows', count(*) FROM drift
        UNION ALL SELECT 'trend_rows', count(*) FROM trends""",
    "crash_then_write": _ALL_SILVER,
    "bootstrap_tables": """SELECT table_name, "column", type, is_partition, CASE table_name
          WHEN 'business_events' THEN (SELECT count(*) FROM silver)
          WHEN 'business' THEN (SELECT count(*) FROM dlq) ELSE 0 END AS rows FROM (VALUES
          ('business_events_raw', 'ingest_ts', 'timestamp', FALSE), ('business_events_raw', 'kafka_partition', 'int', FALSE), ('business_events_raw', 'kafka_offset', 'bigint', FALSE), ('business_events_raw', 'kafka_key', 'string', FALSE), ('business_events_raw', 'raw_envelope', 'string', FALSE), ('business_events_raw', 'kafka_topic', 'string', TRUE), ('business_events_raw', 'ingest_day', 'date', TRUE), ('business_events_raw', 'batch', 'string', TRUE),
          ('business_events', 'business_id', 'string', FALSE), ('business_events', 'name', 'string', FALSE), ('business_events', 'rating', 'double', FALSE), ('business_events', 'review_count', 'int', FALSE), ('business_events', 'price', 'string', FALSE), ('business_events', 'is_closed', 'boolean', FALSE), ('business_events', 'url', 'string', FALSE), ('business_events', 'categories', 'array<string>', FALSE), ('business_events', 'latitude', 'double', FALSE), ('business_events', 'longitude', 'double', FALSE), ('business_events', 'city', 'string', FALSE), ('business_events', 'state', 'string', FALSE), ('business_events', 'country', 'string', FALSE), ('business_events', 'zip_code', 'string', FALSE), ('business_events', 'search_term', 'string', FALSE), ('business_events', 'search_location', 'string', FALSE), ('business_events', 'observed_at', 'timestamp', FALSE), ('business_events', 'ingest_ts', 'timestamp', FALSE), ('business_events', 'event_id', 'string', FALSE), ('business_events', 'producer_id', 'string', FALSE), ('business_events', 'schema_version', 'int', FALSE), ('business_events', 'day', 'date', TRUE),
          ('business', 'dlq_key', 'string', FALSE), ('business', 'ingest_ts', 'timestamp', FALSE), ('business', 'kafka_topic', 'string', FALSE), ('business', 'kafka_partition', 'int', FALSE), ('business', 'kafka_offset', 'bigint', FALSE), ('business', 'kafka_key', 'string', FALSE), ('business', 'failure_codes', 'array<string>', FALSE), ('business', 'raw_envelope', 'string', FALSE), ('business', 'failure_reason', 'string', TRUE), ('business', 'ingest_day', 'date', TRUE),
          ('rating_drift_daily', 'business_id', 'string', FALSE), ('rating_drift_daily', 'name', 'string', FALSE), ('rating_drift_daily', 'city', 'string', FALSE), ('rating_drift_daily', 'rating_avg', 'double', FALSE), ('rating_drift_daily', 'rating_min', 'double', FALSE), ('rating_drift_daily', 'rating_max', 'double', FALSE), ('rating_drift_daily', 'review_count_max', 'int', FALSE), ('rating_drift_daily', 'observations', 'int', FALSE), ('rating_drift_daily', 'day', 'date', TRUE),
          ('category_trends_daily', 'category', 'string', FALSE), ('category_trends_daily', 'city', 'string', FALSE), ('category_trends_daily', 'total_observations', 'bigint', FALSE), ('category_trends_daily', 'distinct_businesses', 'bigint', FALSE), ('category_trends_daily', 'avg_rating', 'double', FALSE), ('category_trends_daily', 'day', 'date', TRUE)
        ) AS t(table_name, "column", type, is_partition)""",
    "replay_lands": """SELECT 'silver' AS place, event_id AS key, ingest_ts, rating FROM (
          SELECT * FROM labelled WHERE failure_reason IS NULL OR codes = ['rating_out_of_range']
          QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts DESC, kafka_offset DESC) = 1)
        UNION ALL SELECT 'quarantine', dlq_key, ingest_ts, NULL FROM dlq
        WHERE codes <> ['rating_out_of_range']""",
    "gold_late_rows": "SELECT * FROM drift",
    "retention_by_day": """SELECT 'quarantine' AS place, kafka_offset, ingest_ts FROM dlq
          WHERE ingest_ts >= TIMESTAMP '2024-01-10 12:00:00'
        UNION ALL SELECT 'bronze', kafka_offset, ingest_ts FROM texts
          WHERE ingest_ts >= TIMESTAMP '2024-01-10 12:00:00'""",
    "bronze_compaction": """SELECT CAST(ingest_ts AS DATE) AS ingest_day,
        CASE WHEN id % 3 = 2 THEN 'recipe-2' ELSE 'compacted' END AS batch, count(*) AS n FROM texts GROUP BY 1, 2""",
}

_LISTING_QUERIES = {
    "listings_explode": """SELECT page_no, position, search_term, search_location, listing
        FROM listings""",
    "listing_normalize": """SELECT page_no, position, business_id, name, rating,
        review_count, is_closed, latitude, longitude, city, url, CAST(NULL AS VARCHAR) AS image_url,
        price, phone, address1, state, 'US' AS country, zip_code,
        CAST(CASE WHEN page_no % 5 = 0 THEN 0 ELSE 1 END AS INTEGER) AS transactions,
        search_term, search_location FROM listings WHERE NOT failed""",
    "category_alias_lists": """SELECT page_no, position,
        coalesce(array_to_string(categories, '|'), '') AS categories
        FROM listings WHERE NOT failed""",
    "coercion_failures": "SELECT page_no, position, listing FROM listings WHERE failed",
    "envelope_stamp": """SELECT page_no, position, concat_ws('-', digest[1:8], digest[9:12],
        digest[13:16], digest[17:20], digest[21:32]) AS event_id, 'p1' AS producer_id,
        'events' AS source, 'businesses/search' AS source_endpoint,
        CAST(1 AS INTEGER) AS schema_version,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS observed_at,
        CAST(250 AS BIGINT) AS ingest_lag_ms, payload_text FROM (SELECT *, sha256('{"p0":"' || page_no
        || '","p1":"' || position || '"}') AS digest FROM listings WHERE NOT failed)""",
    "partition_key": """SELECT page_no, position, CASE WHEN page_no % 101 = 0 THEN 'unknown'
        ELSE business_id END AS key FROM listings""",
    "prepublish_quarantine": """SELECT page_no, position, 'p1' AS producer_id, reason,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS observed_at,
        CASE WHEN failed THEN '' ELSE array_to_string(codes, ',') END AS codes, city
        FROM outcomes WHERE reason IS NOT NULL""",
    "sweep_one_pass": """SELECT 'cities_attempted' AS name, count(DISTINCT search_location) AS rows FROM pages_of_events
        UNION ALL SELECT 'pages_fetched', count(*) FROM pages_of_events
        UNION ALL SELECT 'failed_pages', count(*) FROM pages_of_events WHERE id % 17 = 0
        UNION ALL SELECT 'businesses_seen', count(*) FROM outcomes
        UNION ALL SELECT 'accepted', count(*) FROM outcomes WHERE reason IS NULL
        UNION ALL SELECT 'rejected', count(*) FROM outcomes WHERE reason IS NOT NULL
        UNION ALL SELECT 'topic raw', count(*) FROM outcomes WHERE reason IS NULL
        UNION ALL SELECT 'topic dlq', count(*) FROM outcomes WHERE reason IS NOT NULL
        UNION ALL SELECT 'topic failed', count(*) FROM pages_of_events WHERE id % 17 = 0""",
    "published_records": """SELECT CASE WHEN reason IS NULL THEN 'raw' ELSE 'dlq' END AS topic,
        CASE WHEN page_no % 101 = 0 THEN 'unknown' ELSE business_id END AS key,
        CASE WHEN reason IS NULL THEN '{"event_id":"' || concat_ws('-', digest[1:8], digest[9:12],
            digest[13:16], digest[17:20], digest[21:32]) || '","producer_id":"p1","source":"events",'
            || '"source_endpoint":"businesses/search","schema_version":1,"observed_at":"' || observed_text
            || '","ingest_lag_ms":250,"payload":' || payload_text || '}'
          ELSE '{"producer_id":"p1","reason":"' || reason || '","failures":[' || CASE WHEN failed THEN ''
            ELSE array_to_string(list_transform(failing, lambda f: '{"code":"' || f.code || '","field":"' || f.field
              || '","message":"' || f.message || '"}'), ',') END
            || '],"observed_at":"' || observed_text || '","payload":'
            || CASE WHEN failed THEN listing ELSE payload_text END || '}' END AS value
        FROM (SELECT *, sha256('{"p0":"' || page_no || '","p1":"' || position || '"}') AS digest FROM outcomes)""",
    "sink_records": """SELECT CASE WHEN reason IS NULL THEN 'raw' ELSE 'dlq' END
        AS table_name, count(*) AS rows FROM outcomes GROUP BY 1""",
    "sweep_totals": """SELECT p.search_location, p.search_term,
        grouping(p.search_location, p.search_term) <> 0 AS is_total,
        count(DISTINCT p.search_location) AS cities_attempted,
        count(DISTINCT p.id) AS pages_fetched, count(o.id) AS businesses_seen,
        count(*) FILTER (o.id IS NOT NULL AND o.reason IS NULL) AS accepted,
        count(*) FILTER (o.reason IS NOT NULL) AS rejected
        FROM pages_of_events p LEFT JOIN outcomes o ON p.id = o.id
        GROUP BY GROUPING SETS ((p.search_location, p.search_term), ())""",
}

_OTHER_QUERIES = {
    "document_content_key": """SELECT doc_id, sha256(coalesce(source, '') || '§'
        || coalesce(lang, '') || '§' || coalesce(text, '')) AS content_key FROM documents""",
    "orders_latest_per_customer": """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice
        FROM orders QUALIFY row_number() OVER (
          PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "coercion_kinds": """WITH v AS (SELECT event_id, event_id % 10 AS k,
          CAST(floor(value) AS BIGINT) AS w FROM events)
        SELECT event_id,
          CAST(CASE WHEN k IN (0, 1, 3) THEN w WHEN k IN (2, 4) THEN w + 0.5
               WHEN k = 6 THEN 1 END AS DOUBLE) AS as_double,
          k IN (5, 8, 9) AS bad_double,
          CAST(CASE WHEN k IN (0, 1, 3) THEN w WHEN k = 6 THEN 1 END AS INTEGER) AS as_int,
          k IN (2, 4, 5, 8, 9) AS bad_int,
          CASE WHEN k IN (0, 1, 3) AND w IN (0, 1) THEN w = 1 WHEN k = 6 THEN TRUE
               WHEN k = 8 THEN FALSE END AS as_bool,
          NOT (k IN (6, 7, 8) OR (k IN (0, 1, 3) AND w IN (0, 1) )) AS bad_bool
        FROM v""",
    "ingest_lag": """SELECT event_id, CAST(greatest(0,
        floor(((event_id * 137911) % 5000000 - 1000000) / 1000)) AS BIGINT)
        AS ingest_lag_ms FROM events""",
    "page_failures": """SELECT event_id AS page_no, CASE event_id % 3 WHEN 0 THEN 'page not found'
        WHEN 1 THEN '{"total":1,"businesses":[{"id":"b' ELSE '{"total":1,"businesses":"none"}' END
        AS body FROM events WHERE event_id % 17 = 0""",
    "observed_at_utc": """SELECT event_id, CASE event_id % 7 WHEN 0 THEN ts WHEN 1 THEN ts
        WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts) END
        AS observed_at FROM events""",
}


def statements() -> dict[str, str]:
    return {
        **{k: _from_deliveries(v) for k, v in _DELIVERY_QUERIES.items()},
        **{k: _from_listings(v) for k, v in _LISTING_QUERIES.items()},
        **_OTHER_QUERIES,
    }
