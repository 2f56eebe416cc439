"""Fetched search pages to published and quarantined records, as JSONL or to Kafka.

Pages are Parquet or JSON-lines rows of ``body, search_term, search_location, fetched_at``.
"""

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from jobs.common import report
from tidemark.plans.ingest import ingest_pass
from tidemark.session import build_session
from tidemark.sources.files import write_jsonl_by_topic
from tidemark.sources.kafka import auth_options, write_kafka

PAGES = "body string, search_term string, search_location string, fetched_at timestamp"


def read_pages(spark: SparkSession, path: str, form: str) -> DataFrame:
    return spark.read.schema(PAGES).format(form).load(path)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--pages", required=True)
    p.add_argument("--pages-format", choices=["parquet", "json"], default="parquet")
    p.add_argument("--producer-id", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--raw-topic", required=True)
    p.add_argument("--dlq-topic", required=True)
    p.add_argument("--out", help="directory of JSONL files, one folder per topic")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--failed-topic", default="failed_pages", help="topic of pages that cannot be read")
    args = p.parse_args(argv)
    if bool(args.out) == bool(args.bootstrap):
        raise SystemExit("give --out or --bootstrap")
    spark = build_session("ingest")
    sweep = ingest_pass(read_pages(spark, args.pages, args.pages_format), args.producer_id, args.source,
                        args.raw_topic, args.dlq_topic, args.failed_topic)
    if args.out:
        write_jsonl_by_topic(sweep.records, args.out)
    else:
        auth = auth_options(os.environ.get("KAFKA_USERNAME", ""), os.environ.get("KAFKA_PASSWORD", ""))
        write_kafka(sweep.records, args.bootstrap, auth)
    report("ingest", **sweep.totals())


if __name__ == "__main__":
    main()
