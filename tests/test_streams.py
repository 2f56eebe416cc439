from __future__ import annotations

import os
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from helpers import bronze, envelope
from tidemark.operators.landing import to_bronze_files, to_bronze_kafka
from tidemark.schemas import DLQ, SILVER
from tidemark.session import workspace
from tidemark.sources.files import bronze_stream, file_drop_source, write_jsonl
from tidemark.sources.kafka import auth_options, kafka_source, source_options
from tidemark.streaming.bronze import append_stream, land_files
from tidemark.streaming.silver import process_batch, rebuild, silver_job
from tidemark.tables import ParquetTable


def tables(spark, root):
    return (ParquetTable(spark, f"{root}/silver", SILVER),
            ParquetTable(spark, f"{root}/dlq", DLQ))


def drop(spark, directory, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode(
        "append").text(directory)


def state(silver, dlq):
    return (
        sorted((r["event_id"], r["name"]) for r in silver.read().collect()),
        sorted(r["raw_envelope"] for r in dlq.read().collect()),
    )


def test_file_drop_lands_lines_verbatim_and_resumes(spark):
    root = workspace(spark, "t")
    odd = '{ "payload" : {"business_id":"b9"},  "x":1 }'
    drop(spark, f"{root}/drop", [envelope("a"), odd, "junk"])
    first = land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp")
    drop(spark, f"{root}/drop", [envelope("b")])
    second = land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp")
    assert (first.input_rows, second.input_rows) == (3, 1)
    rows = {r["raw_envelope"]: r for r in spark.read.parquet(f"{root}/bronze").collect()}
    assert set(rows) == {envelope("a"), odd, "junk", envelope("b")}
    assert rows[odd]["kafka_key"] == "b9" and rows["junk"]["kafka_key"] == ""
    assert rows[odd]["kafka_topic"] == "file://volume" and rows[odd]["kafka_offset"] == -1


def test_an_old_file_lands_after_newer_ones(spark):
    root = workspace(spark, "t")
    drop(spark, f"{root}/drop", [envelope("a")])
    land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp")
    before = set(Path(f"{root}/drop").glob("part-*"))
    drop(spark, f"{root}/drop", [envelope("b")])
    for file in set(Path(f"{root}/drop").glob("part-*")) - before:
        os.utime(file, (time.time() - 30 * 86_400,) * 2)
    assert land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp").input_rows == 1
    assert spark.read.parquet(f"{root}/bronze").count() == 2


def test_report_sums_over_micro_batches(spark):
    root = workspace(spark, "t")
    for name in "abcd":
        drop(spark, f"{root}/drop", [envelope(name)])
    report = land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp", max_files=1)
    assert (report.input_rows, report.batches) == (4, 4)


def test_stream_in_small_batches_equals_one_batch_and_rebuild_changes_nothing(spark):
    root = workspace(spark, "t")
    texts = [envelope("a"), envelope("a"), envelope("b", rating=9.9), "junk", "junk",
             envelope("c", observed_at="2026-06-08T23:59:59+00:00")]
    for text in texts:
        drop(spark, f"{root}/drop", [text])
    land_files(spark, f"{root}/drop", f"{root}/bronze", f"{root}/cp-b", max_files=2)
    many = tables(spark, f"{root}/many")
    run = silver_job(spark, f"{root}/bronze", *many, f"{root}/cp-s", max_files=1)
    assert run.run.input_rows == len(texts) and len(run.batches) > 1
    assert sum(b.valid + b.dlq for b in run.batches) == len(texts)
    once = tables(spark, f"{root}/once")
    process_batch(spark.read.parquet(f"{root}/bronze"), *once)
    assert state(*many) == state(*once)
    assert [e for e, _ in state(*many)[0]] == ["a", "c"]
    # Equal bad lines of a drop are one quarantine row.
    assert len(state(*many)[1]) == 2
    before = state(*many)
    rebuild(spark, f"{root}/bronze", *many, f"{root}/cp-again")
    assert state(*many) == before


def test_latest_delivery_wins_within_and_across_batches(spark):
    silver, dlq = tables(spark, workspace(spark, "t"))
    first = bronze(spark, [envelope("a", name="old"), envelope("a", name="new")])
    process_batch(first, silver, dlq, 0)
    assert state(silver, dlq)[0] == [("a", "new")]
    process_batch(bronze(spark, [envelope("a", name="newest")], 5, 1), silver, dlq, 1)
    assert state(silver, dlq)[0] == [("a", "newest")]


def test_hot_event_id_leaves_one_row(spark):
    silver, dlq = tables(spark, workspace(spark, "t"))
    rows = bronze(spark, [envelope("hot")] * 300 + [envelope("x"), envelope("y")])
    report = process_batch(rows, silver, dlq)
    assert report.valid == 302
    assert [e for e, _ in state(silver, dlq)[0]] == ["hot", "x", "y"]


def test_batch_without_valid_rows(spark):
    silver, dlq = tables(spark, workspace(spark, "t"))
    report = process_batch(bronze(spark, ["junk", "[1]"]), silver, dlq)
    assert (report.valid, report.dlq, report.unparseable) == (0, 2, 2)
    assert silver.read().count() == 0 and dlq.read().count() == 2


def test_failure_of_a_stream_is_raised(spark):
    root = workspace(spark, "t")
    drop(spark, f"{root}/drop", ["x"])
    broken = to_bronze_files(file_drop_source(spark, f"{root}/drop")).selectExpr(
        "ingest_ts", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key",
        "raise_error('no') AS raw_envelope",
    )
    with pytest.raises(StreamingQueryException):
        append_stream(broken, f"{root}/bronze", f"{root}/cp")


def test_bronze_stream_reads_a_directory(spark):
    root = workspace(spark, "t")
    bronze(spark, ["x"]).write.partitionBy("kafka_topic").parquet(f"{root}/bronze")
    assert bronze_stream(spark, f"{root}/bronze", max_files=5).isStreaming


def test_kafka_projection(spark):
    records = spark.sql("""SELECT cast('k' AS binary) AS key, cast('v' AS binary) AS value,
        't' AS topic, 3 AS partition, 7L AS offset, current_timestamp() AS timestamp,
        0 AS timestampType""")
    row = to_bronze_kafka(records, "timestamp'2026-01-01 00:00:00Z'").first()
    assert (row["kafka_topic"], row["kafka_partition"], row["kafka_offset"]) == ("t", 3, 7)
    assert (row["kafka_key"], row["raw_envelope"]) == ("k", "v")


def test_kafka_options():
    auth = auth_options("user", "pw")
    assert auth["kafka.security.protocol"] == "SASL_SSL"
    assert auth["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="user" password="pw";' in auth["kafka.sasl.jaas.config"]
    options = source_options("t", "host:9092", auth, max_offsets=10)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true" and options["maxOffsetsPerTrigger"] == "10"
    assert auth_options() == {}
    with pytest.raises(ValueError):
        source_options("t", "")
    with pytest.raises(ValueError):
        auth_options("user", 'p"w')


def test_kafka_source_names_the_missing_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_source(spark, "t", "host:9092")


def test_secrets_are_redacted(spark):
    assert "jaas" in spark.conf.get("spark.sql.redaction.options.regex")


def test_jsonl_mirror_appends(spark):
    root = workspace(spark, "t")
    frame = spark.createDataFrame([("t", "k", "v1")], "topic string, key string, value string")
    write_jsonl(frame, f"{root}/raw")
    write_jsonl(frame, f"{root}/raw")
    assert spark.read.text(f"{root}/raw").count() == 2
