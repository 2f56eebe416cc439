"""Plans: each row is decoded once, and by as many tasks as there are, however few files hold it."""

from __future__ import annotations

import re

import pytest

from checks import queries
from tests.helpers import bronze, envelope
from tidemark import recipe
from tidemark.operators.decode import decode, split_parsed
from tidemark.streaming import silver as stream
from tidemark.tables import paths
from tidemark.tables.kept import kept
from tidemark.tables.parquet import ParquetTable
from tidemark.schemas import BRONZE, DLQ, SILVER

TEXTS = [envelope("e1"), envelope("e2", rating=9.9), envelope("e3") + "\f", envelope("e4") + "{}", envelope("e5") + " x",
         envelope("e6") + " ", "not json", " ", None]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def write_events(spark, root, n=1):
    rows = spark.range(n * 1000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-29 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type",
        "1.5D AS value", "'{}' AS props")
    rows.coalesce(1).write.parquet(f"{root}/events.parquet")
    return str(root)


def test_a_filter_on_the_outcome_does_not_copy_what_the_text_is_computed_from(spark):
    rows = bronze(spark, TEXTS).selectExpr("*", "upper(lower(raw_envelope)) AS text")
    for part in split_parsed(decode(rows, "text")):
        assert plan(part).count("upper(lower(") <= 1


def test_trailing_text_is_told_as_before(spark):
    parsed, _ = split_parsed(decode(bronze(spark, TEXTS)))
    assert {r["kafka_offset"] for r in parsed.collect()} == {0, 1, 2}


def test_events_are_dealt_out(spark, tmp_path):
    assert "Rebalance" in plan(recipe.events(spark, write_events(spark, tmp_path)))


@pytest.mark.parametrize("name", ["valid_invalid_split", "dlq_union", "table_counts"])
def test_results_of_one_table_share_one_decode(spark, tmp_path, name):
    assert "from_json" not in plan(queries.registry()[name](spark, write_events(spark, tmp_path)))


def test_a_batch_of_few_files_is_dealt_out(spark, tmp_path, monkeypatch):
    bronze(spark, TEXTS[:3]).selectExpr("*", "date'2024-01-29' AS ingest_day", "'q-0' AS batch").select(
        *BRONZE.column_names).write.partitionBy(*BRONZE.partition_by).parquet(f"{tmp_path}/bronze")
    plans = []
    real = stream.process_batch
    monkeypatch.setattr(stream, "process_batch", lambda batch, *a: (plans.append(plan(batch)), real(batch, *a))[1])
    silver, dlq = ParquetTable(spark, f"{tmp_path}/silver", SILVER), ParquetTable(spark, f"{tmp_path}/dlq", DLQ)
    stream.silver_job(spark, f"{tmp_path}/bronze", silver, dlq, f"{tmp_path}/cp", max_files=1)
    assert plans and all("Rebalance" in p for p in plans)
    assert {r["event_id"] for r in silver.read().collect()} == {"e1", "e3"}


def test_rows_of_a_batch_are_not_left_in_the_tasks_that_made_them(spark, tmp_path, monkeypatch):
    plans = []
    for name in ("upsert", "insert_absent", "_append"):
        real = getattr(ParquetTable, name)
        monkeypatch.setattr(ParquetTable, name, lambda self, df, *a, _real=real, **k: (plans.append(plan(df)), _real(self, df, *a, **k))[1])
    silver, dlq = ParquetTable(spark, f"{tmp_path}/silver", SILVER), ParquetTable(spark, f"{tmp_path}/dlq", DLQ)
    for _ in range(2):
        report = stream.process_batch(bronze(spark, TEXTS), silver, dlq)
        assert (report.valid, report.dlq) == (2, len(TEXTS) - 2)
    assert len(plans) == 6 and not any("InMemoryRelation" in p or "from_json" in p for p in plans)
    assert silver.read().count() == 2 and dlq.read().count() == len(TEXTS) - 2


def test_kept_rows_go_when_they_were_used(spark):
    with kept(spark.range(100).repartition(50), "rows") as rows:
        assert rows.rdd.getNumPartitions() < 50 and rows.count() == 100
        (path,) = {f.rpartition("/")[0] for f in rows.inputFiles()}
    assert not paths.exists(spark, path)


def test_braces_are_told_by_bytes(spark):
    texts = [envelope("e1", name="\u00e9\u6f22\U0001f600"), envelope("e2", name="\u6f22") + "}", envelope("e3", name="\u00e9") + " }"]
    decoded = decode(bronze(spark, texts))
    assert not re.search(r"(?<!_)length\(replace", plan(decoded))
    assert {r["kafka_offset"] for r in split_parsed(decoded)[0].collect()} == {0}
