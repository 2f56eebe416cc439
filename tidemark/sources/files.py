"""JSONL drops in and out, and the bronze directory as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import BRONZE

# Files older than the newest seen one by more than this are not landed. Spark's own
# default of a week loses backfills and copies that keep their times; the price of a long age
# is that the source remembers more file names.
MAX_FILE_AGE = "36500d"


def file_drop_source(
    spark: SparkSession,
    directory: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Streaming lines of text files, existing ones included, each line verbatim.

    ``max_files`` or ``max_bytes`` bounds each micro-batch, so that the first drain
    of a large backlog is many batches of one size.
    """
    reader = spark.readStream.format("text").option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(directory)


def bronze_stream(
    spark: SparkSession,
    table: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Bronze as an append-only stream; ``table`` is a directory or a catalog name."""
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if "/" in table:
        return reader.schema(BRONZE.columns).parquet(table)
    return reader.table(table)


def write_jsonl(records: DataFrame, directory: str, column: str = "value") -> None:
    """Mirror outgoing records, one per line."""
    records.select(column).write.mode("append").text(directory)


def write_jsonl_by_topic(records: DataFrame, directory: str) -> None:
    """Mirror records of several topics in one pass, to ``<directory>/topic=<topic>``.

    A file drop reads one of these directories, so quarantine records never pass for
    envelopes.
    """
    records.select("topic", "value").write.mode("append").partitionBy("topic").text(directory)
