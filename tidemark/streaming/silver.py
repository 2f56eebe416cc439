"""Bronze to silver and quarantine, one idempotent micro-batch at a time."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quarantine import REASON_PARSE, classify, split_classified
from tidemark.operators.silver import DELIVERY, latest_delivery, to_silver, with_day
from tidemark.sources.files import bronze_stream
from tidemark.streaming.drain import RunReport, drain
from tidemark.tables.kept import kept
from tidemark.tables.merge import MergeTable
from tidemark.tables.notes import DayNotes
from tidemark.tables.parquet import ParquetTable, observed

Table = ParquetTable | MergeTable

# Kept with the flattened rows while both outputs are written. The envelope text is
# only needed where it goes to quarantine; a hash of it ranks equal deliveries.
_SHARED = (
    *DELIVERY,
    "kafka_topic", "kafka_partition", "kafka_key", "failure_reason", "failure_codes",
    "CASE WHEN failure_reason IS NOT NULL THEN raw_envelope END AS raw_envelope",
)


_COUNTED = {
    "valid": "failure_reason IS NULL",
    "dlq": "failure_reason IS NOT NULL",
    "unparseable": f"failure_reason = '{REASON_PARSE}'",
}


@dataclass(frozen=True)
class BatchReport:
    """Row counts of one micro-batch; ``valid + dlq`` is everything that came in.

    ``days`` are the silver days that were appended to or rewritten.
    """

    batch_id: int
    valid: int
    dlq: int
    unparseable: int
    days: tuple = ()


@dataclass
class SilverRun:
    run: RunReport | None = None
    batches: list[BatchReport] = field(default_factory=list)


def flattened(bronze: DataFrame) -> DataFrame:
    """Bronze rows decoded and labelled once, with all that silver and quarantine need of them."""
    return to_silver(classify(bronze), keep=_SHARED)


def process_batch(
    bronze: DataFrame,
    silver: Table,
    dlq: Table,
    batch_id: int = 0,
    keys_keep_partition: bool = False,
    notes: DayNotes | None = None,
) -> BatchReport:
    """Validate a batch, upsert the good rows, quarantine the rest.

    The batch is parsed once and shared by both outputs. A crash between the two
    writes repeats the batch, which neither table notices.
    """
    seen, counted = Observation(), [F.expr(f"count_if({test})").alias(name) for name, test in _COUNTED.items()]
    with kept(flattened(bronze).observe(seen, *counted), "batch") as rows:
        valid, quarantined = split_classified(rows)
        written = silver.upsert(
            with_day(latest_delivery(valid)), keys_keep_partition=keys_keep_partition,
            before=notes and notes.before("silver"),
        )
        # Known once the rows were kept, by their first use at the latest.
        counts = observed(seen) or rows.agg(*counted).first().asDict()
        if counts["dlq"]:
            # Topic and offset are part of the hashed key, so equal keys have equal ones.
            dlq.insert_absent(quarantined, implied_by_key=("kafka_topic", "kafka_offset"))
        touched = written.touched if written else ()
        return BatchReport(batch_id, counts["valid"], counts["dlq"], counts["unparseable"], touched)


def silver_job(
    spark: SparkSession,
    bronze: str,
    silver: Table,
    dlq: Table,
    checkpoint: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    keys_keep_partition: bool = False,
    notes: DayNotes | None = None,
) -> SilverRun:
    """Drain bronze into silver and quarantine, then exit.

    The days that change are left in ``notes`` for gold. A new checkpoint re-reads all of bronze and leaves both tables as they are.
    """
    result = SilverRun()

    def apply(batch: DataFrame, batch_id: int) -> None:
        # A batch of few files is as few tasks: it is dealt out evenly before it is decoded.
        result.batches.append(
            process_batch(batch.hint("rebalance"), silver, dlq, batch_id, keys_keep_partition, notes)
        )

    query = (
        bronze_stream(spark, bronze, max_files, max_bytes)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    result.run = drain(spark, query)
    return result


def rebuild(
    spark: SparkSession, bronze: str, silver: Table, dlq: Table, fresh_checkpoint: str, **limits
) -> SilverRun:
    """Reprocess all of bronze under a new, empty checkpoint."""
    return silver_job(spark, bronze, silver, dlq, fresh_checkpoint, **limits)
