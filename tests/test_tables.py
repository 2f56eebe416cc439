from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.schemas import TableSpec
from tidemark.session import workspace
from tidemark.tables import MergeTable, ParquetTable, open_table, paths
from tidemark.tables.upkeep import compact, file_sizes, prune, small_file_partitions

SPEC = TableSpec(
    "s", "t", "k string, v int, observed_at timestamp, day date",
    partition_by=("day",), keys=("k",), cluster_by=("k",),
)


def rows(spark, data):
    """Rows (k, v, day of January 2024)."""
    return spark.createDataFrame(data, "k string, v int, d int").selectExpr(
        "k", "v", "timestamp_micros((19722L + d) * 86400000000L + 3600000000L) AS observed_at",
        "date_from_unix_date(19722 + d) AS day",
    )


def content(table):
    return {r["k"]: (r["v"], r["day"].day) for r in table.read().collect()}


def files(table):
    return {r["path"] for r in file_sizes(table.spark, table.path).collect()}


@pytest.fixture
def table(spark):
    return ParquetTable(spark, f"{workspace(spark, 'test')}/t", SPEC)


def test_empty_table_reads_with_its_schema(table):
    assert table.read().columns == ["k", "v", "observed_at", "day"]
    assert table.read().count() == 0


def test_upsert_inserts_updates_and_leaves_other_days_alone(spark, table):
    first = table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]))
    assert (first.appended, first.rewritten) == (3, ())
    before = files(table)
    report = table.upsert(rows(spark, [("b", 20, 2), ("d", 4, 3), ("e", 5, 2)]))
    assert report.touched == (dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert report.rewritten == (dt.date(2024, 1, 2),)
    assert content(table) == {"a": (1, 1), "b": (20, 2), "c": (3, 3), "d": (4, 3), "e": (5, 2)}
    kept = {f for f in before if "2024-01-02" not in f}
    assert kept <= files(table)


def test_replay_rewrites_nothing(spark, table):
    batch = rows(spark, [("a", 1, 1), ("b", 2, 2)])
    table.upsert(batch)
    before = files(table)
    report = table.upsert(batch)
    assert (report.appended, report.rewritten) == (0, ())
    assert files(table) == before


@pytest.mark.parametrize("into", [2, 9])
def test_key_that_moves_to_another_day_exists_once(spark, table, into):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2)]))
    table.upsert(rows(spark, [("a", 10, into)]))
    assert content(table) == {"a": (10, into), "b": (2, 2)}
    assert not paths.exists(spark, f"{table.path}/day=2024-01-01")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.integers(0, 2), st.integers(1, 3)),
                    min_size=1),
    min_size=1, max_size=3,
))
def test_upserts_equal_a_dictionary(spark, batches):
    table = ParquetTable(spark, f"{workspace(spark, 'prop')}/t", SPEC)
    model = {}
    for batch in batches:
        table.upsert(rows(spark, [(k, v, d) for k, (v, d) in batch.items()]))
        model.update(batch)
    assert content(table) == model


def test_crash_before_the_replacement_is_binding_changes_nothing(spark, table):
    table.upsert(rows(spark, [("a", 1, 1)]))
    rows(spark, [("a", 9, 1)]).write.partitionBy("day").parquet(f"{table.path}/_pending/rows")
    table.recover()
    assert content(table) == {"a": (1, 1)}
    assert not paths.exists(spark, f"{table.path}/_pending")


def test_crash_during_the_replacement_is_finished_by_the_next_write(spark, table, monkeypatch):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 1)]))
    with monkeypatch.context() as patch:
        patch.setattr(ParquetTable, "recover", lambda self: None)
        table.upsert(rows(spark, [("a", 10, 1)]))
    # The driver died after the live day was deleted.
    paths.delete(spark, f"{table.path}/day=2024-01-01")
    report = table.upsert(rows(spark, [("a", 10, 1)]))
    assert content(table) == {"a": (10, 1), "b": (2, 1)}
    assert report.rewritten == ()


def half_replaced(spark, table, monkeypatch):
    """Day 1 is to become a=10, day 2 to go; the driver died before the first directory moved."""
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]))
    with monkeypatch.context() as patch:
        patch.setattr(ParquetTable, "recover", lambda self: None)
        table.overwrite(rows(spark, [("a", 10, 1)]), [dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    paths.delete(spark, f"{table.path}/day=2024-01-01")


AFTER = {"a": (10, 1), "c": (3, 3)}
WRITERS = {
    "append": (lambda s, t: t.append(rows(s, [("x", 7, 1)])), {"x": (7, 1)}),
    "insert": (lambda s, t: t.insert_absent(rows(s, [("x", 7, 2), ("a", 5, 1)])), {"x": (7, 2)}),
    "upsert": (lambda s, t: t.upsert(rows(s, [("x", 7, 3)])), {"x": (7, 3)}),
    "replace": (lambda s, t: t.replace_days(rows(s, [("a", 99, 1), ("c", 3, 3)]), dt.date(2024, 1, 1)), {"a": (99, 1)}),
    "drop": (lambda s, t: t.drop_partitions([dt.date(2024, 1, 9)]), {}),
    "compact": (lambda s, t: compact(t, 1), {}),
}


@pytest.mark.parametrize("name", list(WRITERS))
def test_every_writer_finishes_a_replacement_first(spark, table, monkeypatch, name):
    half_replaced(spark, table, monkeypatch)
    write, change = WRITERS[name]
    write(spark, table)
    assert content(table) == AFTER | change
    assert not paths.exists(spark, f"{table.path}/_pending")
    compact(table, 1)
    assert content(table) == AFTER | change


def test_readers_see_the_replacement_before_it_is_moved(spark, table, monkeypatch):
    half_replaced(spark, table, monkeypatch)
    assert content(table) == AFTER
    paths.move(spark, f"{table.path}/_pending/rows/day=2024-01-01", f"{table.path}/day=2024-01-01")
    assert content(table) == AFTER
    table.recover()
    assert content(table) == AFTER


def test_insert_absent_where_an_implied_column_has_no_value(spark, table):
    data = rows(spark, [("a", None, 1), ("b", None, 1)])
    assert table.insert_absent(data, implied_by_key=["v"]) == 2
    assert table.insert_absent(data.union(rows(spark, [("c", 4, 1)])), implied_by_key=["v"]) == 1
    assert table.insert_absent(rows(spark, [("d", None, 1)]), implied_by_key=["v"]) == 1


def test_pinned_partitions_give_the_same_result(spark, table):
    table.upsert(rows(spark, [("a", 1, 1), ("b", 2, 2)]))
    table.upsert(rows(spark, [("b", 3, 2), ("c", 4, 2)]), keys_keep_partition=True)
    assert content(table) == {"a": (1, 1), "b": (3, 2), "c": (4, 2)}


def test_insert_absent_keeps_the_first_row(spark, table):
    assert table.insert_absent(rows(spark, [("a", 1, 1), ("a", 1, 1), ("b", 2, 1)])) == 2
    assert table.insert_absent(rows(spark, [("a", 9, 1), ("c", 3, 2)])) == 1
    assert content(table) == {"a": (1, 1), "b": (2, 1), "c": (3, 2)}


def test_insert_absent_with_a_range_on_implied_columns(spark, table):
    table.insert_absent(rows(spark, [("a", 1, 1), ("b", 2, 1)]), implied_by_key=["v"])
    again = rows(spark, [("b", 2, 1), ("c", 5, 1)])
    assert table.insert_absent(again, implied_by_key=["v"]) == 1
    assert table.insert_absent(rows(spark, []), implied_by_key=["v"]) == 0
    assert len(content(table)) == 3


def test_replace_days_drops_vanished_days_and_keeps_history(spark, table):
    table.replace_days(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]), dt.date(2024, 1, 1))
    written = table.replace_days(rows(spark, [("x", 9, 2)]), dt.date(2024, 1, 2))
    assert written == 1
    assert content(table) == {"a": (1, 1), "x": (9, 2)}


def test_compaction_keeps_rows_and_reduces_files(spark, table):
    data = [(f"k{i}", i, 1 + i % 2) for i in range(200)]
    for part in range(4):
        rows(spark, data[part::4]).repartition(3).write.mode("append").partitionBy(
            "day"
        ).parquet(table.path)
    before, wanted = len(files(table)), content(table)
    assert small_file_partitions(table, 1).count() == 2
    assert compact(table, target_mb=1) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert content(table) == wanted and len(files(table)) < before
    assert compact(table, target_mb=1) == []


def test_prune_drops_old_days_and_cuts_the_boundary_day(spark, table):
    table.append(rows(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]))
    table.append(rows(spark, [("d", 4, 2)]).selectExpr(
        "k", "v", "observed_at + interval 20 hours AS observed_at", "day"))
    now = dt.datetime(2024, 1, 3, 12, tzinfo=dt.timezone.utc)
    dropped, rewritten = prune(table, "observed_at", dt.timedelta(hours=24), now)
    assert (dropped, rewritten) == ([dt.date(2024, 1, 1)], [dt.date(2024, 1, 2)])
    assert content(table) == {"c": (3, 3), "d": (4, 2)}


def test_prune_on_another_partitioning(spark):
    spec = TableSpec("s", "r", "k string, v int, observed_at timestamp, day date, r string",
                     partition_by=("r",), keys=("k",))
    other = ParquetTable(spark, f"{workspace(spark, 'test')}/r", spec)
    other.append(rows(spark, [("a", 1, 1), ("b", 2, 9)]).selectExpr("*", "'x' AS r"))
    other.append(rows(spark, [("c", 1, 1)]).selectExpr("*", "'y' AS r"))
    now = dt.datetime(2024, 1, 9, 12, tzinfo=dt.timezone.utc)
    assert prune(other, "observed_at", dt.timedelta(days=1), now) == ([], ["x", "y"])
    assert [r["k"] for r in other.read().collect()] == ["b"]


def test_upkeep_refuses_a_directory_with_a_sink_log(spark, table):
    table.append(rows(spark, [("a", 1, 1)]))
    spark.range(1).write.parquet(f"{table.path}/_spark_metadata")
    with pytest.raises(ValueError, match="streaming sink"):
        compact(table)


def test_hot_partition_is_written_by_many_tasks(spark, table):
    frame = rows(spark, [(f"k{i}", i, 1) for i in range(50)])
    plan = table.laid_out(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" in plan


def test_merge_statements_parse(spark):
    merge = open_table(spark, "silver.t", SPEC, "delta")
    assert isinstance(merge, MergeTable)
    parser = spark._jsparkSession.sessionState().sqlParser()
    for update in (True, False):
        text = merge.merge_statement("src", ["k"], update, ["day"])
        assert "t.k = s.k AND t.day = s.day" in text
        assert "MergeIntoTable" in parser.parsePlan(text).toString()


def test_order_of_batches_does_not_matter_for_new_keys(spark):
    data = [(f"k{i}", i, 1 + i % 3) for i in range(30)]
    results = []
    for seed in (1, 2):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        t = ParquetTable(spark, f"{workspace(spark, 'order')}/t", SPEC)
        for at in range(0, 30, 15):
            t.upsert(rows(spark, shuffled[at:at + 15]))
        results.append(content(t))
    assert results[0] == results[1]
