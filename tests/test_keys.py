"""The key side table, retention by directory, replays, late days and landing."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

from helpers import bronze, envelope
from test_tables import SPEC, content, rows
from tidemark.functions.rules import ENVELOPE_RULES
from tidemark.operators.quarantine import classify, split_classified
from tidemark.plans.gold import gold_job
from tidemark.plans.replay import replay_job
from tidemark.schemas import BRONZE, CATEGORY_TRENDS, DLQ, RATING_DRIFT, SILVER
from tidemark.session import workspace
from tidemark.sources.files import bronze_stream
from tidemark.streaming import bronze as landing
from tidemark.streaming.bronze import land_batch, land_files
from tidemark.streaming.silver import process_batch
from tidemark.tables import ParquetTable, paths
from tidemark.tables.notes import DayNotes
from tidemark.tables.upkeep import compact, compact_landed, prune

D = [dt.date(2024, 1, n) for n in range(1, 10)]  # D[0] is the first of January


@pytest.fixture
def table(spark):
    return ParquetTable(spark, f"{workspace(spark, 'keys')}/t", SPEC)


def spoil(table, day):
    """Make a day's files unreadable: whoever reads them fails."""
    for file in Path(f"{table.path}/day={day.isoformat()}").glob("*.parquet"):
        file.write_bytes(b"not a parquet file")


def entries(table):
    return {r["k"]: r["day"] for r in table.index.read().collect()}


def test_a_batch_is_joined_once_with_keys_only(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2)]))
    judged = table._judged(rows(spark, [("b", 3, 2), ("c", 1, 4)]), ["k"], True, False, False)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    scans = [f for f in judged.inputFiles()]
    assert scans and all("/_keys/" in f for f in scans)
    assert {r["k"]: r["_status"] for r in judged.collect()} == {"b": "changed", "c": "new"}


def test_only_changed_days_are_read(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]))
    spoil(table, D[0])
    report = table.upsert(rows(spark, [("a", 1, 1), ("b", 20, 2), ("d", 4, 1), ("e", 5, 5)]))
    assert report.rewritten == (D[1],) and report.touched == (D[0], D[1], D[4])
    assert entries(table) == {"a": D[0], "b": D[1], "c": D[2], "d": D[0], "e": D[4]}


def test_nulls_that_change_places_are_a_change(spark):
    spec = type(SPEC)("s", "n", "k string, x string, y string, day date", partition_by=("day",), keys=("k",))
    table = ParquetTable(spark, f"{workspace(spark, 'keys')}/n", spec)
    frame = lambda x, y: spark.createDataFrame([("a", x, y)], "k string, x string, y string").selectExpr(
        "*", "date'2024-01-01' AS day")
    table.upsert(frame("v", None))
    assert table.upsert(frame(None, "v")).rewritten == (D[0],)
    assert table.upsert(frame(None, "v")).touched == ()


def test_a_dead_driver_leaves_keys_that_are_read_again(spark, table, monkeypatch):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2)]))
    with monkeypatch.context() as patch:
        # Rows are in the table, their keys are not.
        patch.setattr(type(table.index), "add", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            table.upsert(rows(spark, [("c", 3, 2)]))
    spoil(table, D[0])
    assert table.upsert(rows(spark, [("c", 3, 2), ("b", 2, 2)])).touched == ()
    assert entries(table) == {"a": D[0], "b": D[1], "c": D[1]}


def test_other_writers_keep_or_renew_the_keys(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]))
    table.drop_partitions([D[0]])
    assert table.upsert(rows(spark, [("a", 1, 1)])).appended == 1
    table.overwrite(rows(spark, [("x", 9, 2)]), [D[1]])
    assert table.upsert(rows(spark, [("b", 2, 2), ("x", 9, 2)])).appended == 1
    table.append(rows(spark, [("y", 1, 4)]))
    assert table.upsert(rows(spark, [("y", 1, 4)])).touched == ()
    compact(table, 1)
    assert content(table) == {"a": (1, 1), "b": (2, 2), "c": (3, 3), "x": (9, 2), "y": (1, 4)}
    assert set(entries(table)) == set(content(table))


def test_delete_and_find(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 3)]))
    spoil(table, D[2])
    keys = spark.createDataFrame([("a",), ("zz",)], "k string")
    assert [r["k"] for r in table.find(keys).collect()] == ["a"]
    table.drop_partitions([D[2]])
    assert table.delete(keys) == (1, (D[0],))
    assert content(table) == {"b": (2, 1)}


def test_expired_days_go_unread(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 5)]))
    spoil(table, D[0])
    spoil(table, D[4])
    now = dt.datetime(2024, 1, 3, 2, tzinfo=dt.timezone.utc)
    assert prune(table, "observed_at", dt.timedelta(hours=24), now) == ([D[0]], [D[1]])
    assert table.partitions() == [D[4]]


def quarantine(spark, root):
    dlq = ParquetTable(spark, f"{root}/dlq", DLQ)
    texts = [envelope("a", rating=9.9), "junk", envelope("b", rating=9.9, name="")]
    dlq.insert_absent(split_classified(classify(bronze(spark, texts)))[1])
    later = split_classified(classify(bronze(spark, [envelope("c", rating=9.9)], 10, 3 * 1440)))[1]
    dlq.insert_absent(later)
    return dlq


def test_quarantine_has_days_and_expires_by_them(spark):
    dlq = quarantine(spark, workspace(spark, "q"))
    first, later = dt.date(2026, 6, 9), dt.date(2026, 6, 12)
    assert sorted(dlq.partitions()) == [
        ("envelope_parse_failed", first), ("silver_validation", first), ("silver_validation", later)]
    now = dt.datetime(2026, 6, 12, 12, tzinfo=dt.timezone.utc)
    dropped, rewritten = prune(dlq, "ingest_ts", dt.timedelta(days=1), now)
    assert len(dropped) == 2 and rewritten == []
    assert [r["kafka_offset"] for r in dlq.read().collect()] == [10]
    assert compact(dlq, 1) == []


@pytest.mark.parametrize("compacted", [False, True])
def test_known_keys_are_looked_for_where_they_can_be(spark, compacted):
    dlq = quarantine(spark, workspace(spark, "q"))
    for i in range(4):
        junk = bronze(spark, [f"junk {i}"], 20 + i).selectExpr("*").withColumn("kafka_topic", _lit("file://volume"))
        dlq.insert_absent(split_classified(classify(junk.withColumn("kafka_offset", _lit(-1).cast("long"))))[1])
    if compacted:
        assert compact(dlq, 1) == [("envelope_parse_failed", dt.date(2026, 6, 9))]
    spark.conf.set("spark.sql.maxMetadataStringLength", 3000)  # of the plan's text
    for topic in ("t", "file://volume"):
        held = dlq.read().filter(_col("kafka_topic") == topic)
        where = dlq._where_keys_can_be(held, ["dlq_key"], ["kafka_topic", "kafka_offset"])
        plan = dlq.read().filter(where).select("dlq_key")._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert f"EqualTo(kafka_topic,{topic})" in pushed and "GreaterThanOrEqual(kafka_offset" in pushed
        assert "In(dlq_key" in pushed or "EqualTo(dlq_key" in pushed
        assert dlq.insert_absent(held, implied_by_key=("kafka_topic", "kafka_offset")) == 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


WITHOUT_SCALE = [r for r in ENVELOPE_RULES if r.code != "rating_out_of_range"]


def test_replay_lands_and_a_dead_run_is_finished(spark, monkeypatch):
    root = workspace(spark, "replay")
    silver, dlq = ParquetTable(spark, f"{root}/silver", SILVER), quarantine(spark, root)
    # The producer has sent c again, in order, before the rule was withdrawn.
    process_batch(bronze(spark, [envelope("c", name="newer")], 30, 9 * 1440), silver, dlq)
    notes = DayNotes(spark, f"{root}/notes")
    with monkeypatch.context() as patch:
        patch.setattr(ParquetTable, "delete", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            replay_job(silver, dlq, WITHOUT_SCALE, notes=notes)
    names = {r["event_id"]: r["name"] for r in silver.read().collect()}
    assert names == {"a": "Lantern & Page", "c": "newer"}
    assert dlq.read().count() == 4
    report = replay_job(silver, dlq, WITHOUT_SCALE, notes=notes)
    assert (report.rescued, report.days) == (2, ())
    assert sorted(r["kafka_offset"] for r in dlq.read().collect()) == [1, 2]
    assert {r["event_id"]: r["name"] for r in silver.read().collect()} == names
    assert list(notes.read().values()) == [[dt.date(2026, 6, 9)]]
    assert replay_job(silver, dlq, WITHOUT_SCALE).rescued == 0


def test_late_days_reach_gold_once(spark):
    root = workspace(spark, "late")
    silver, dlq = ParquetTable(spark, f"{root}/silver", SILVER), ParquetTable(spark, f"{root}/dlq", DLQ)
    drift, trends = (ParquetTable(spark, f"{root}/{s.name}", s) for s in (RATING_DRIFT, CATEGORY_TRENDS))
    notes = DayNotes(spark, f"{root}/notes")
    old = "2026-05-01T10:00:00+00:00"
    process_batch(bronze(spark, [envelope("a"), envelope("b", observed_at=old)]), silver, dlq, 0, notes=notes)
    gold_job(silver.read(), drift, trends, dt.date(2026, 6, 9), days=None, notes=notes)
    assert notes.read() == {}
    process_batch(bronze(spark, [envelope("c", observed_at=old)], 5), silver, dlq, 1, notes=notes)
    report = gold_job(silver.read(), drift, trends, dt.date(2026, 6, 9), notes=notes)
    assert report.late_days == (dt.date(2026, 5, 1),) and notes.read() == {}
    assert {r["day"]: r["observations"] for r in drift.read().collect()} == {
        dt.date(2026, 5, 1): 2, dt.date(2026, 6, 9): 1}
    # A noted day that has lost its rows goes; days of the window stay.
    silver.drop_partitions([dt.date(2026, 5, 1)])
    notes.add("prune", [dt.date(2026, 5, 1)])
    gold_job(silver.read(), drift, trends, dt.date(2026, 8, 1), notes=notes)
    assert drift.partitions() == [dt.date(2026, 6, 9)]


def test_notes_added_meanwhile_stay(spark):
    notes = DayNotes(spark, f"{workspace(spark, 'notes')}/days")
    notes.add("silver", [D[0]])
    seen = notes.read()
    notes.add("silver", [D[1]])
    notes.clear(seen)
    assert notes.read() == {"silver.json": [D[1]]}


def test_a_batch_that_is_repeated_lands_once(spark, monkeypatch):
    root = workspace(spark, "land")
    spark.createDataFrame([(envelope("a"),), ("junk",)], "value string").coalesce(1).write.text(f"{root}/drop")
    real = landing.land_batch

    def dies(*args):
        real(*args)
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "land_batch", dies)
        with pytest.raises(Exception, match="died"):
            land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp")
    table = ParquetTable(spark, f"{root}/bronze", BRONZE)
    before = table.partitions()
    assert table.read().count() == 2
    assert land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp").input_rows == 2
    assert table.partitions() == before and table.read().count() == 2
    assert not paths.exists(spark, f"{root}/bronze/_spark_metadata")


def test_landed_batches_are_compacted_and_pruned(spark):
    table = ParquetTable(spark, f"{workspace(spark, 'land')}/bronze", BRONZE)
    for i in range(4):
        land_batch(bronze(spark, [f"x{i}", f"y{i}"], 2 * i, 1440 * (i // 3)), table.path, "q", i)
    first, second = dt.date(2026, 6, 9), dt.date(2026, 6, 10)
    assert compact_landed(table) == [("t", first, "compacted")]
    assert sorted(table.partitions()) == [("t", first, "compacted"), ("t", second, "q-3")]
    assert sorted(r["kafka_offset"] for r in table.read().collect()) == list(range(8))
    assert compact_landed(table) == []
    assert bronze_stream(spark, table.path).isStreaming
    now = dt.datetime(2026, 6, 11, 0, tzinfo=dt.timezone.utc)
    assert prune(table, "ingest_ts", dt.timedelta(days=1), now) == ([("t", first, "compacted")], [])
    assert sorted(r["raw_envelope"] for r in table.read().collect()) == ["x3", "y3"]


def test_a_directory_of_a_sink_log_is_refused(spark):
    root = workspace(spark, "land")
    spark.range(1).write.parquet(f"{root}/bronze/_spark_metadata")
    spark.createDataFrame([("junk",)], "value string").write.text(f"{root}/drop")
    with pytest.raises(ValueError, match="log of a streaming sink"):
        land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp")


def test_every_progress_event_counts(spark):
    root = workspace(spark, "many")
    for i in range(7):
        spark.createDataFrame([(f"junk {i}",)], "value string").coalesce(1).write.mode("append").text(f"{root}/drop")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        report = land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp", max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (report.input_rows, report.batches) == (7, 7)
