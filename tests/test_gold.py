from __future__ import annotations

import datetime as dt

import pytest

from tidemark.operators.gold import (
    category_trends_daily,
    category_trends_from,
    compact_tallies,
    rating_drift_daily,
    rating_drift_from,
    recompute_window,
    tallies,
    window_start,
)
from tidemark.operators.silver import with_day
from tidemark.plans.gold import gold_job
from tidemark.schemas import ALL_TABLES, CATEGORY_TRENDS, RATING_DRIFT, SILVER
from tidemark.session import workspace
from tidemark.tables import ParquetTable
from tidemark.tables.bootstrap import bootstrap, location, sync_partitions, table_statement

TODAY = dt.date(2024, 1, 30)


def silver(spark, data):
    """Observations (business, name, rating, reviews, categories, UTC time text)."""
    return with_day(spark.createDataFrame(
        data, "business_id string, name string, rating double, review_count int, "
        "categories array<string>, at string",
    ).selectExpr("*", "'Trondheim' AS city", "cast(concat(at, 'Z') AS timestamp) AS observed_at",
                 "concat(business_id, at) AS event_id"))


DATA = [
    ("b1", "old", 3.0, 10, ["a", "b"], "2024-01-29 10:00:00"),
    ("b1", "new", 4.0, 12, ["a"], "2024-01-29 11:00:00"),
    ("b2", "x", 5.0, 1, ["a", None], "2024-01-29 23:59:59.999999"),
    ("b2", "x", 1.0, 2, ["c"], "2024-01-30 00:30:00"),
    ("b1", "past", 2.0, 3, ["a"], "2024-01-28 12:00:00"),
]


def as_rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_drift(spark):
    rows = as_rows(rating_drift_daily(silver(spark, DATA)), "day", "business_id", "name",
                   "rating_avg", "rating_min", "rating_max", "review_count_max", "observations")
    assert rows == [
        (dt.date(2024, 1, 28), "b1", "past", 2.0, 2.0, 2.0, 3, 1),
        (dt.date(2024, 1, 29), "b1", "new", 3.5, 3.0, 4.0, 12, 2),
        (dt.date(2024, 1, 29), "b2", "x", 5.0, 5.0, 5.0, 1, 1),
        (dt.date(2024, 1, 30), "b2", "x", 1.0, 1.0, 1.0, 2, 1),
    ]


def test_trends(spark):
    rows = as_rows(category_trends_daily(silver(spark, DATA)), "day", "category",
                   "total_observations", "distinct_businesses", "avg_rating")
    assert rows == [
        (dt.date(2024, 1, 28), "a", 1, 1, 2.0),
        (dt.date(2024, 1, 29), "a", 3, 2, 4.0),
        (dt.date(2024, 1, 29), "b", 1, 1, 3.0),
        (dt.date(2024, 1, 30), "c", 1, 1, 1.0),
    ]


def test_average_ignores_null_ratings(spark):
    data = [("b", "n", None, 1, ["a"], "2024-01-29 10:00:00"),
            ("b", "n", 4.0, 1, ["a"], "2024-01-29 11:00:00"),
            ("c", "n", None, 1, ["z"], "2024-01-29 11:00:00")]
    rows = as_rows(rating_drift_daily(silver(spark, data)), "business_id", "rating_avg",
                   "observations")
    assert rows == [("b", 4.0, 2), ("c", None, 1)]


def test_merged_tallies_give_the_same_tables(spark):
    frame = silver(spark, DATA * 3)
    merged = compact_tallies(tallies(frame))
    for direct, derived in (
        (rating_drift_daily(frame), rating_drift_from(merged)),
        (category_trends_daily(frame), category_trends_from(merged)),
    ):
        assert sorted(map(str, direct.collect())) == sorted(map(str, derived.collect()))


def test_window(spark):
    assert window_start(TODAY, 2) == dt.date(2024, 1, 29)
    with pytest.raises(ValueError):
        window_start(TODAY, 0)
    frame = silver(spark, [*DATA, ("b3", "n", 1.0, 1, ["a"], "2024-02-10 00:00:00")])
    assert recompute_window(frame, TODAY).count() == 5
    assert recompute_window(frame.drop("day"), TODAY).count() == 5
    assert recompute_window(frame, TODAY, cap_at_today=True).count() == 4


def test_window_bounds_reach_the_scan(spark):
    root = workspace(spark, "t")
    silver(spark, DATA).write.partitionBy("day").parquet(f"{root}/by_day")
    silver(spark, DATA).drop("day").write.parquet(f"{root}/flat")

    def plan(path):
        frame = recompute_window(spark.read.parquet(f"{root}/{path}"), TODAY)
        return frame._jdf.queryExecution().executedPlan().toString()

    assert "PartitionFilters: [isnotnull(day" in plan("by_day")
    assert "GreaterThanOrEqual(observed_at" in plan("flat")


def gold_tables(spark):
    root = workspace(spark, "gold")
    return (ParquetTable(spark, f"{root}/drift", RATING_DRIFT),
            ParquetTable(spark, f"{root}/trends", CATEGORY_TRENDS))


def test_job_replaces_the_window_only(spark):
    drift, trends = gold_tables(spark)
    full = gold_job(silver(spark, DATA), drift, trends, TODAY, days=30)
    assert (full.rating_drift_rows, full.category_trends_rows) == (4, 4)
    later = [("b9", "n", 4.5, 1, ["q"], "2024-01-30 01:00:00")]
    report = gold_job(silver(spark, later), drift, trends, TODAY)
    assert (report.as_of, report.rating_drift_rows) == (dt.date(2024, 1, 29), 1)
    # The 29th vanished with its rows, the 28th is history.
    assert as_rows(drift.read(), "day", "business_id") == [
        (dt.date(2024, 1, 28), "b1"), (dt.date(2024, 1, 30), "b9")
    ]
    assert as_rows(trends.read(), "day", "category") == [
        (dt.date(2024, 1, 28), "a"), (dt.date(2024, 1, 30), "q")
    ]


def test_window_over_all_days_equals_a_full_run(spark):
    drift, trends = gold_tables(spark)
    gold_job(silver(spark, DATA), drift, trends, TODAY, days=None)
    columns = drift.read().columns
    assert as_rows(drift.read(), *columns) == as_rows(
        rating_drift_daily(silver(spark, DATA)), *columns)


def test_empty_window_is_a_no_op(spark):
    drift, trends = gold_tables(spark)
    gold_job(silver(spark, DATA), drift, trends, TODAY, days=30)
    before = as_rows(drift.read(), "day", "business_id")
    report = gold_job(silver(spark, DATA), drift, trends, dt.date(2024, 6, 1))
    assert report.skipped and as_rows(drift.read(), "day", "business_id") == before


def test_bootstrap_creates_tables_once_and_serves_path_writes(spark):
    root = workspace(spark, "boot")
    for _ in range(2):
        bootstrap(spark, root=root)
    names = {t.full_name for t in ALL_TABLES}
    assert all(spark.catalog.tableExists(n) for n in names)
    table = ParquetTable(spark, location(RATING_DRIFT, root), RATING_DRIFT)
    table.replace_days(rating_drift_daily(silver(spark, DATA)), dt.date(2024, 1, 1))
    sync_partitions(spark, RATING_DRIFT)
    assert spark.table(RATING_DRIFT.full_name).count() == 4
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_layouts():
    assert "PARTITIONED BY (kafka_topic, ingest_day, batch)" in table_statement(ALL_TABLES[0])
    text = table_statement(SILVER, fmt="delta", properties={"a.b": "it's"})
    assert "business_id string NOT NULL" in text and "event_id string," in text and "TBLPROPERTIES ('a.b' = " in text
    assert "NOT NULL" not in table_statement(SILVER)
    text = table_statement(SILVER, "cat", "delta", properties={"a": "b"})
    assert text.startswith("CREATE TABLE IF NOT EXISTS cat.silver.business_events (")
    assert "USING delta" in text and "TBLPROPERTIES ('a' = 'b')" in text
