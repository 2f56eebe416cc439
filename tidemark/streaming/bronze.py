"""Source to bronze: append every record once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import utc_day
from tidemark.operators.landing import to_bronze_files, to_bronze_kafka
from tidemark.schemas import BRONZE
from tidemark.sources.files import file_drop_source
from tidemark.sources.kafka import kafka_source
from tidemark.streaming.drain import RunReport, drain
from tidemark.tables import paths
from tidemark.tables.parquet import ParquetTable


def land_batch(rows: DataFrame, directory: str, query: str, batch_id: int) -> None:
    """Write a micro-batch of bronze rows to directories that are named by query and batch.

    The whole of each directory is replaced. A repeated batch has the same rows and, as the stream's clock is
    logged with the batch, the same days: it lands once, and nothing keeps a list of files.
    """
    table = ParquetTable(rows.sparkSession, directory, BRONZE)
    table.recover()
    landed = rows.withColumns({
        "ingest_day": F.expr(utc_day("ingest_ts")), "batch": F.lit(f"{query}-{batch_id}"),
    }).select(*BRONZE.column_names)
    (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*BRONZE.partition_by).parquet(table.path))


def append_stream(df: DataFrame, table: str, checkpoint: str) -> RunReport:
    """Append a stream to a bronze directory or catalog table, then exit.

    A directory is written batch by batch (see :func:`land_batch`), so it may be compacted, pruned and
    read as any other. A catalog table is left to its format's own sink.
    """
    spark = df.sparkSession
    if "/" not in table:
        days = df.withColumns({"ingest_day": F.expr(utc_day("ingest_ts")), "batch": F.lit("stream")})
        by_name = days.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return drain(spark, by_name.partitionBy(*BRONZE.partition_by).outputMode("append").toTable(table))
    if paths.exists(spark, f"{table.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{table} is defined by the log of a streaming sink; land into a new directory")

    def land(rows: DataFrame, batch_id: int) -> None:
        query = json.loads(paths.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        land_batch(rows, table, query, batch_id)

    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return drain(spark, writer.foreachBatch(land).start())


def land_files(
    spark: SparkSession, directory: str, table: str, checkpoint: str, **source
) -> RunReport:
    """Drain a JSONL drop directory into bronze."""
    lines = file_drop_source(spark, directory, **source)
    return append_stream(to_bronze_files(lines), table, checkpoint)


def land_kafka(
    spark: SparkSession, topic: str, bootstrap: str, table: str, checkpoint: str, **source
) -> RunReport:
    """Drain a topic into bronze."""
    records = kafka_source(spark, topic, bootstrap, **source)
    return append_stream(to_bronze_kafka(records), table, checkpoint)
