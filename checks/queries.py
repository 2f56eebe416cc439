"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import recipe
from tidemark.functions import variants
from tidemark.functions.rules import ENVELOPE_RULES
from tidemark.functions.text import content_key
from tidemark.functions.times import lag_ms, to_utc, utc_instant, utc_wall_clock
from tidemark.operators import gold, reports
from tidemark.operators.decode import decode, split_parsed
from tidemark.operators.envelope import (
    EVENT_KEY,
    content_event_id,
    outcomes,
    prepublish_split,
    stamp,
    sweep_report,
)
from tidemark.operators.landing import to_bronze_kafka
from tidemark.operators.normalize import normalize, split_normalized
from tidemark.operators.quarantine import (
    classify,
    replay_dlq,
    split_classified,
    union_failures,
)
from tidemark.operators.silver import (
    dedup_latest,
    latest_delivery,
    latest_observations,
    to_silver,
    with_day,
)
from tidemark.operators.validate import (
    annotate_failures,
    failure_details,
    failure_summary,
    split_valid,
)
from tidemark.plans.gold import gold_job
from tidemark.plans.ingest import ingest, ingest_pass
from tidemark.plans.replay import replay_job
from tidemark.schemas import ALL_TABLES, BRONZE, CATEGORY_TRENDS, DLQ, RATING_DRIFT, SILVER
from tidemark.session import workspace
from tidemark.sources.files import write_jsonl, write_jsonl_by_topic
from tidemark.sources.pages import explode_listings, failed_pages
from tidemark.streaming.bronze import land_batch, land_files
from tidemark.streaming.silver import flattened, process_batch, rebuild, silver_job
from tidemark.tables.bootstrap import bootstrap, location, sync_partitions
from tidemark.tables.notes import DayNotes
from tidemark.tables.parquet import ParquetTable
from tidemark.tables.upkeep import compact, compact_landed, prune, small_file_partitions

TODAY = dt.date.fromisoformat(recipe.TODAY)
Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- shared frames -------------------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(recipe.bronze(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_classified(_classified(spark, sf_dir))
    return with_day(latest_observations(valid))


def _dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_classified(_classified(spark, sf_dir))[1]


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rating_drift_daily(_silver(spark, sf_dir))


def _trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_trends_daily(_silver(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(normalize(explode_listings(recipe.pages(spark, sf_dir))))


def _stored(spark: SparkSession, label: str, rows: DataFrame) -> DataFrame:
    """Rows that several results share, written once and read back."""
    path = f"{workspace(spark, label)}/rows"
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _joined(column: str) -> str:
    return f"array_join({column}, '|') AS {column.rpartition('.')[2]}"


def _wall(column: str) -> str:
    return f"{utc_wall_clock(column)} AS {column}"


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_normalized(normalize(explode_listings(recipe.pages(spark, sf_dir))))


def _silver_view(df: DataFrame, *more: str) -> DataFrame:
    """Silver columns in types both engines compare alike."""
    return df.selectExpr(
        "event_id", "business_id", "name", "rating", "review_count", _joined("categories"),
        "latitude", "longitude", "city", "country", "search_term", "search_location",
        "producer_id", "schema_version", "url", "is_closed", "price", "state", "zip_code",
        _wall("observed_at"), _wall("ingest_ts"),
        *more,
    )


def _drift_view(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "day", "business_id", "name", "city", "round(rating_avg, 6) AS rating_avg",
        "rating_min", "rating_max", "review_count_max", "observations",
    )


def _trends_view(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "day", "category", "city", "total_observations", "distinct_businesses",
        "round(avg_rating, 6) AS avg_rating",
    )


def _dlq_view(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "dlq_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key",
        "failure_reason", _joined("failure_codes"), "raw_envelope",
        _wall("ingest_ts"),
    )


def _tables(spark: SparkSession, label: str) -> tuple[ParquetTable, ParquetTable]:
    root = workspace(spark, label)
    return ParquetTable(spark, f"{root}/silver", SILVER), ParquetTable(spark, f"{root}/dlq", DLQ)


def _gold_tables(spark: SparkSession, label: str) -> tuple[ParquetTable, ParquetTable]:
    root = workspace(spark, label)
    return (
        ParquetTable(spark, f"{root}/drift", RATING_DRIFT),
        ParquetTable(spark, f"{root}/trends", CATEGORY_TRENDS),
    )


# -- decode and validate -------------------------------------------------------


@query
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = split_parsed(decode(recipe.bronze(spark, sf_dir)))
    p = "env.payload"
    return parsed.selectExpr(
        "kafka_offset", "env.event_id", f"{p}.business_id", f"{p}.name", f"{p}.rating",
        f"{p}.review_count", _joined(f"{p}.categories"), f"{p}.coordinates.latitude",
        f"{p}.coordinates.longitude", f"{p}.location.city",
        _wall("observed_at"),
    )


@query
def envelope_unparseable(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, unparsed = split_parsed(decode(recipe.bronze(spark, sf_dir)))
    return unparsed.select("kafka_key", "kafka_offset", "raw_envelope")


@query
def failure_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = split_parsed(decode(recipe.bronze(spark, sf_dir)))
    codes = annotate_failures(parsed).select(F.explode("failure_codes").alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query
def failure_details_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = split_parsed(decode(recipe.bronze(spark, sf_dir)))
    return failure_details(parsed).select("kafka_offset", F.inline("failures"))


@query
def failure_summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = split_parsed(decode(recipe.bronze(spark, sf_dir)))
    return failure_summary(failure_details(parsed)).select("kafka_offset", "failure_summary")


@query
def valid_invalid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = annotate_failures(decode(recipe.bronze(spark, sf_dir))).select("env_check", "failure_codes")
    parsed, unparsed = split_parsed(_stored(spark, "split", checked))
    valid, invalid = split_valid(parsed)
    return reports.table_counts({"valid": valid, "invalid": invalid, "unparsed": unparsed})


# -- silver and quarantine -----------------------------------------------------


@query
def silver_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_classified(_classified(spark, sf_dir))
    return _silver_view(to_silver(valid, keep=["kafka_offset"]), "kafka_offset")


@query
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_view(_silver(spark, sf_dir))


@query
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All first deliveries, then all redeliveries: the later copy wins."""
    silver, dlq = _tables(spark, "silver-upsert")
    rows = recipe.bronze(spark, sf_dir)
    first = F.col("kafka_offset") % 2 == 0
    process_batch(rows.filter(first), silver, dlq, 0)
    process_batch(rows.filter(~first), silver, dlq, 1)
    return _silver_view(silver.read())


@query
def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch twice leaves the table as it is."""
    silver, dlq = _tables(spark, "silver-replay")
    for batch_id in range(2):
        process_batch(recipe.bronze(spark, sf_dir), silver, dlq, batch_id)
    return _silver_view(silver.read())


@query
def dlq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dlq_view(_dlq(spark, sf_dir))


@query
def dlq_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = recipe.bronze(spark, sf_dir)
    checked = annotate_failures(decode(bronze)).select(*bronze.columns, "env_check", "failure_codes")
    failing = checked.filter("NOT env_check.parsed OR size(failure_codes) > 0")
    parsed, unparsed = split_parsed(_stored(spark, "dlq-union", failing))
    _, broken = split_valid(parsed)
    return _dlq_view(union_failures(broken, unparsed.drop("failure_codes")))


@query
def dlq_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine rows of a batch and its replay are stored once."""
    _, dlq = _tables(spark, "dlq-insert")
    rows = _dlq(spark, sf_dir)
    for _ in range(2):
        dlq.insert_absent(rows, implied_by_key=("kafka_offset",))
    return _dlq_view(dlq.read())


@query
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows checked again after the rating scale rule is withdrawn."""
    rules = [r for r in ENVELOPE_RULES if r.code != "rating_out_of_range"]
    again = replay_dlq(_dlq(spark, sf_dir), rules)
    return again.selectExpr(
        "kafka_offset",
        "coalesce(failure_reason, 'valid') AS outcome",
        _joined("failure_codes"),
    )


@query
def document_content_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.selectExpr("doc_id", f"{content_key(['source', 'lang', 'text'])} AS content_key")


@query
def orders_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    latest = dedup_latest(orders, ["o_custkey"], ["o_orderdate DESC", "o_orderkey DESC"])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


# -- landing and streams -------------------------------------------------------


@query
def kafka_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped like Kafka records, landed as bronze."""
    records = recipe.bronze(spark, sf_dir).select(
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_key").cast("binary").alias("key"),
        F.col("raw_envelope").cast("binary").alias("value"),
    )
    return to_bronze_kafka(records).drop("ingest_ts")


def _dropped_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    drop = f"{root}/drop"
    write_jsonl(recipe.bronze(spark, sf_dir).repartition("kafka_offset"), drop, "raw_envelope")
    return drop


@query
def bronze_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace(spark, "bronze")
    drop = _dropped_files(spark, sf_dir, root)
    land_files(spark, drop, f"{root}/bronze", f"{root}/cp", max_files=3)
    rows = spark.read.parquet(f"{root}/bronze")
    return rows.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key", "raw_envelope"
    )


@query
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop, bronze stream, silver stream in several micro-batches, then a rebuild."""
    root = workspace(spark, "stream")
    drop = _dropped_files(spark, sf_dir, root)
    land_files(spark, drop, f"{root}/bronze", f"{root}/cp-bronze")
    silver = ParquetTable(spark, f"{root}/silver", SILVER)
    dlq = ParquetTable(spark, f"{root}/dlq", DLQ)
    silver_job(spark, f"{root}/bronze", silver, dlq, f"{root}/cp-silver", max_files=3)
    rebuild(spark, f"{root}/bronze", silver, dlq, f"{root}/cp-rebuild")
    return _silver_view(silver.read()).drop("ingest_ts")


# -- gold ----------------------------------------------------------------------


@query
def day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query
def gold_window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = gold.recompute_window(_silver(spark, sf_dir).drop("day"), TODAY)
    return window.select("event_id", "business_id", "day")


@query
def rating_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift_view(_drift(spark, sf_dir))


@query
def rating_drift_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift, trends = _gold_tables(spark, "drift-window")
    gold_job(_silver(spark, sf_dir), drift, trends, TODAY)
    return _drift_view(drift.read())


@query
def category_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trends_view(_trends(spark, sf_dir))


@query
def category_trends_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift, trends = _gold_tables(spark, "trends-window")
    gold_job(_silver(spark, sf_dir), drift, trends, TODAY)
    return _trends_view(trends.read())


@query
def gold_replace_keeps_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from altered counts, then a window run on the real ones."""
    drift, trends = _gold_tables(spark, "history")
    silver = _silver(spark, sf_dir)
    altered = silver.withColumn("review_count", F.col("review_count") + 1000)
    gold_job(altered, drift, trends, TODAY, days=None)
    gold_job(silver, drift, trends, TODAY)
    return _drift_view(drift.read())


@query
def gold_empty_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window without observations leaves the table alone."""
    drift, trends = _gold_tables(spark, "empty-window")
    silver = _silver(spark, sf_dir)
    gold_job(silver, drift, trends, TODAY, days=None)
    gold_job(silver, drift, trends, TODAY + dt.timedelta(days=300))
    return _trends_view(trends.read())


# -- reports -------------------------------------------------------------------


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = recipe.bronze(spark, sf_dir)
    valid, dlq = split_classified(_stored(spark, "counts-rows", flattened(bronze)))
    silver = _stored(spark, "counts-silver", with_day(latest_delivery(valid)))
    return reports.table_counts({
        "bronze.business_events_raw": bronze,
        "silver.business_events": silver,
        "gold.rating_drift_daily": gold.rating_drift_daily(silver),
        "gold.category_trends_daily": gold.category_trends_daily(silver),
        "dlq.business": dlq,
    })


@query
def dlq_by_reason_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dlq_by_reason_code(_dlq(spark, sf_dir))


@query
def dlq_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dlq_by_code(_dlq(spark, sf_dir))


@query
def drift_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = reports.drift_recent(_drift(spark, sf_dir), TODAY)
    return recent.withColumn("rating_avg", F.round("rating_avg", 6))


@query
def trending_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trending_rollup(_trends(spark, sf_dir), TODAY)


@query
def trending_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.trending_top(_trends(spark, sf_dir), TODAY)


@query
def latest_observations_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.latest_silver(_silver(spark, sf_dir))
    return latest.withColumn("observed_at", F.expr(utc_wall_clock("observed_at")))


@query
def business_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = reports.business_history(_drift(spark, sf_dir), "b8")
    return history.withColumn("rating_avg", F.round("rating_avg", 6))


@query
def bronze_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = reports.bronze_freshness(recipe.bronze(spark, sf_dir))
    return fresh.withColumn("latest_ingest_ts", F.expr(utc_wall_clock("latest_ingest_ts")))


@query
def log_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.log_volume(recipe.bronze(spark, sf_dir))


@query
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.log_head(recipe.bronze(spark, sf_dir), "events")


# -- ingest --------------------------------------------------------------------


@query
def listings_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_listings(recipe.pages(spark, sf_dir))
    return rows.select("page_no", "position", "search_term", "search_location", "listing")


@query
def page_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that cannot be read, with their raw bodies."""
    return failed_pages(recipe.pages(spark, sf_dir)).select("page_no", "body")


@query
def listing_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = _listings(spark, sf_dir)
    p = "payload"
    return usable.select(
        "page_no", "position", f"{p}.business_id", f"{p}.name", f"{p}.rating",
        f"{p}.review_count", f"{p}.is_closed", f"{p}.coordinates.latitude",
        f"{p}.coordinates.longitude", f"{p}.location.city", f"{p}.url", f"{p}.image_url", f"{p}.price",
        f"{p}.phone", f"{p}.location.address1", f"{p}.location.state", f"{p}.location.country",
        f"{p}.location.zip_code", F.size(f"{p}.transactions").alias("transactions"), f"{p}.search_term",
        f"{p}.search_location",
    )


@query
def category_alias_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = _listings(spark, sf_dir)
    return usable.selectExpr("page_no", "position", _joined("payload.categories"))


@query
def coercion_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that cannot be normalised, with the listing text."""
    _, failed = _listings(spark, sf_dir)
    return failed.select("page_no", "position", "listing")


@query
def coercion_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's value in one of ten JSON spellings, coerced three ways."""
    whole = "cast(floor(value) AS string)"
    spellings = [
        whole,
        f"concat({whole}, '.0')",
        f"concat({whole}, '.5')",
        f"""concat('"', {whole}, '"')""",
        f"""concat('"', {whole}, '.5"')""",
        """concat('"', event_type, '"')""",
        "'true'",
        "'null'",
        """'"No"'""",
        f"concat('[', {whole}, ']')",
    ]
    text = f"element_at(array({', '.join(spellings)}), cast(event_id % 10 + 1 AS int))"
    rows = recipe.events(spark, sf_dir).selectExpr("event_id", f"parse_json({text}) AS v")
    leaf = variants.Leaf.of("v")
    coerced = {
        "double": variants.to_double(leaf),
        "int": variants.to_integer(leaf),
        "bool": variants.to_boolean(leaf),
    }
    return rows.selectExpr(
        "event_id",
        *[f"{c.value} AS as_{k}" for k, c in coerced.items()],
        *[f"{c.bad} AS bad_{k}" for k, c in coerced.items()],
    )


@query
def envelope_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = _listings(spark, sf_dir)
    stamped = stamp(
        usable,
        producer_id="p1",
        source="events",
        now="fetched_at + interval 250 milliseconds",
        event_id=content_event_id("page_no", "position"),
    )
    payload = F.to_json("envelope.payload", {"ignoreNullFields": "false"}).alias("payload_text")
    return stamped.select("page_no", "position", "envelope.*", payload).drop("payload")


@query
def ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks from one second behind the fetch to four seconds after it."""
    fetched = utc_instant("ts")
    micros = "((event_id * 137911L) % 5000000L - 1000000L)"
    now = f"timestamp_micros(unix_micros({fetched}) + {micros})"
    return recipe.events(spark, sf_dir).selectExpr(
        "event_id", f"{lag_ms(now, fetched)} AS ingest_lag_ms"
    )


@query
def observed_at_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive, offset, Zulu, date-only and unusable texts of every event's time."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    texts = [
        f'date_format(ts, "{iso}")',
        f"""concat(date_format(ts + interval 2 hours, "{iso}"), '+02:00')""",
        "concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'Z')",
        "date_format(ts, 'yyyy-MM-dd')",
        "date_format(ts, 'HH:mm:ss')",
        "concat(date_format(ts, 'HH:mm:ss'), '+00:00')",
        "event_type",
    ]
    text = f"element_at(array({', '.join(texts)}), cast(event_id % 7 + 1 AS int))"
    return (
        recipe.events(spark, sf_dir)
        .selectExpr("event_id", f"{text} AS observed_text")
        .selectExpr("event_id", f"{to_utc('observed_text')} AS instant")
        .selectExpr("event_id", f"{utc_wall_clock('instant')} AS observed_at")
    )


@query
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, invalid = prepublish_split(_labelled(spark, sf_dir), "p1", "events")
    published = valid.selectExpr("page_no", "position", f"{EVENT_KEY} AS key")
    return published.unionByName(invalid.selectExpr("page_no", "position", "dlq_key AS key"))


@query
def prepublish_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = prepublish_split(_labelled(spark, sf_dir), "p1", "events")
    record = F.from_json(
        "dlq_record",
        "producer_id string, reason string, observed_at string, "
        "failures array<struct<code:string,field:string,message:string>>, payload string",
    )
    summary = F.array_join(F.transform("r.failures", lambda f: f["code"]), ",")
    return invalid.withColumn("r", record).select(
        "page_no", "position", "r.producer_id", "r.reason", "r.observed_at",
        summary.alias("codes"),
        F.get_json_object("r.payload", "$.location.city").alias("city"),
    )


@query
def published_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, key and text of every record of both topics, as they would go to the broker."""
    sweep = ingest(
        recipe.pages(spark, sf_dir), "p1", "events", "raw", "dlq",
        now="fetched_at + interval 250 milliseconds", event_id=content_event_id("page_no", "position"),
    )
    return sweep.records.select("topic", "key", "value")


@query
def sweep_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write of all records: what it counted, and what lies in each topic."""
    root = workspace(spark, "one-pass")
    sweep = ingest_pass(recipe.pages(spark, sf_dir), "p1", "events", "raw", "dlq", "failed")
    write_jsonl_by_topic(sweep.records, root)
    counted = spark.createDataFrame(list(sweep.totals().items()), "name string, rows long")
    written = spark.read.text(root).groupBy(F.concat(F.lit("topic "), "topic").alias("name")).agg(
        F.count(F.lit(1)).alias("rows"))
    return counted.unionByName(written)


@query
def bootstrap_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrapped tables by name: columns, types and partition columns of the catalog, and rows written by path."""
    root, prefix = workspace(spark, "bootstrap"), f"tidemark_{uuid.uuid4().hex[:12]}_"
    specs = [dataclasses.replace(s, schema_name=prefix + s.schema_name) for s in ALL_TABLES]
    by_name = {s.name: s for s in specs}
    bootstrap(spark, root=root, tables=specs)
    silver, dlq = (ParquetTable(spark, location(by_name[s.name], root), s) for s in (SILVER, DLQ))
    process_batch(recipe.bronze(spark, sf_dir), silver, dlq)
    found = []
    for spec in specs:
        if spec.name in (SILVER.name, DLQ.name):
            sync_partitions(spark, spec)
        rows = spark.table(spec.full_name).count()
        parts = {c.name for c in spark.catalog.listColumns(spec.full_name) if c.isPartition}
        found += [(spec.name, f.name, f.dataType.simpleString(), f.name in parts, rows) for f in spark.table(spec.full_name).schema]
        spark.sql(f"DROP TABLE {spec.full_name}")
    for name in {s.schema_name for s in specs}:
        spark.sql(f"DROP SCHEMA {name}")
    return spark.createDataFrame(found, "table_name string, column string, type string, is_partition boolean, rows long")


@query
def sink_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of both topics mirrored as JSONL in one pass and read back."""
    root = workspace(spark, "sink")
    sweep = ingest(recipe.pages(spark, sf_dir), "p1", "events", "raw", "dlq")
    write_jsonl_by_topic(sweep.records, root)
    counts = {
        topic: spark.read.text(f"{root}/topic={topic}").filter(
            F.get_json_object("value", "$.producer_id") == "p1"
        )
        for topic in ("raw", "dlq")
    }
    return reports.table_counts(counts)


@query
def sweep_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep_report(_labelled(spark, sf_dir), recipe.pages(spark, sf_dir))


# -- upkeep --------------------------------------------------------------------


@query
def retention_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, _ = _tables(spark, "prune")
    silver.append(_silver(spark, sf_dir))
    now = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)
    prune(silver, "observed_at", dt.timedelta(days=10), now)
    return _silver_view(silver.read())


@query
def compaction_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, _ = _tables(spark, "compact")
    valid, _ = split_classified(_classified(spark, sf_dir))
    rows = with_day(latest_observations(valid))
    # Written without a layout step: many small files per day.
    rows.repartition("event_id").write.partitionBy("day").parquet(silver.path)
    compact(silver, target_mb=16)
    return _silver_view(silver.read())


@query
def compaction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose files are few enough after compaction, and what a second run rewrites."""
    silver, _ = _tables(spark, "compact-files")
    rows = _silver(spark, sf_dir)
    rows.repartition("event_id").write.partitionBy("day").parquet(silver.path)
    compact(silver, target_mb=16)
    left = [r["day"] for r in small_file_partitions(silver, 16).select(F.col("day").cast("date").alias("day")).collect()]
    again = compact(silver, target_mb=16)
    return silver.read().groupBy("day").agg(F.count(F.lit(1)).alias("n")).select(
        "day", "n", (~F.col("day").isin(left)).alias("few_files"), F.col("day").isin(again).alias("rewritten_again")
    )


@query
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the landing, silver and gold runs report about themselves."""
    root = workspace(spark, "reports")
    landed = land_files(spark, _dropped_files(spark, sf_dir, root), f"{root}/bronze", f"{root}/cp")
    silver, dlq = _tables(spark, "reports")
    batch = process_batch(recipe.bronze(spark, sf_dir), silver, dlq)
    result = gold_job(silver.read(), *_gold_tables(spark, "reports"), TODAY, days=None)
    counts = {
        "bronze_rows": landed.input_rows, "valid": batch.valid, "dlq": batch.dlq,
        "unparseable": batch.unparseable, "drift_rows": result.rating_drift_rows,
        "trend_rows": result.category_trends_rows,
    }
    return spark.createDataFrame(list(counts.items()), "report string, rows long")


@query
def replay_lands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarantined batch after the rating scale rule is withdrawn: what is in silver now, and what is left."""
    silver, dlq = _tables(spark, "replay")
    process_batch(recipe.bronze(spark, sf_dir), silver, dlq)
    rules = [r for r in ENVELOPE_RULES if r.code != "rating_out_of_range"]
    for _ in range(2):  # the second run finds nothing to do
        replay_job(silver, dlq, rules, codes=["rating_out_of_range"])
    landed = silver.read().selectExpr("'silver' AS place", "event_id AS key", _wall("ingest_ts"), "rating")
    left = dlq.read().selectExpr("'quarantine' AS place", "dlq_key AS key", _wall("ingest_ts"), "cast(null AS double) AS rating")
    return landed.unionByName(left)


@query
def gold_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event arrives after gold was built: the days it falls on are built again."""
    silver, dlq = _tables(spark, "late")
    drift, trends = _gold_tables(spark, "late")
    notes = DayNotes(spark, f"{workspace(spark, 'late-notes')}/days")
    rows = recipe.bronze(spark, sf_dir)
    late = F.expr("kafka_offset div 2 % 10 = 3")
    process_batch(rows.filter(~late), silver, dlq, 0, notes=notes)
    gold_job(silver.read(), drift, trends, TODAY, days=None, notes=notes)
    process_batch(rows.filter(late), silver, dlq, 1, notes=notes)
    gold_job(silver.read(), drift, trends, TODAY, notes=notes)
    return _drift_view(drift.read())


@query
def retention_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine and bronze after twenty days: whole days go by name, the day of the cut is rewritten."""
    root = workspace(spark, "retention")
    _, dlq = _tables(spark, "retention")
    dlq.append(_dlq(spark, sf_dir))
    bronze = ParquetTable(spark, f"{root}/bronze", BRONZE)
    land_batch(recipe.bronze(spark, sf_dir), bronze.path, "recipe", 0)
    now, kept = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc), {}
    for name, table in (("quarantine", dlq), ("bronze", bronze)):
        prune(table, "ingest_ts", dt.timedelta(days=20), now)
        kept[name] = table.read().selectExpr(f"'{name}' AS place", "kafka_offset", _wall("ingest_ts"))
    return kept["quarantine"].unionByName(kept["bronze"])


@query
def bronze_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze landed in several batches, compacted, and drained into silver."""
    root = workspace(spark, "bronze-compact")
    bronze = ParquetTable(spark, f"{root}/bronze", BRONZE)
    rows = recipe.bronze(spark, sf_dir)
    for i in range(3):
        part = rows.filter(F.expr(f"kafka_offset div 2 % 3 = {i}"))
        for _ in range(2):  # a repeated batch lands once
            land_batch(part, bronze.path, "recipe", i)
    compact_landed(bronze)
    return bronze.read().groupBy("ingest_day", "batch").agg(F.count(F.lit(1)).alias("n"))


@query
def crash_then_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement that a dead driver left binding, then another writer: nothing reverts."""
    silver, _ = _tables(spark, "crash")
    rows = _silver(spark, sf_dir)
    silver.append(rows.withColumn("name", F.lit("before")))
    days = silver.partition_values(silver.read(), "day")
    dead = ParquetTable(spark, silver.path, SILVER)
    dead.recover = lambda: None
    dead.overwrite(rows, days)
    silver.append(rows.limit(0))
    silver.recover()
    return _silver_view(silver.read())
