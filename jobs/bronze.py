"""Drain a file drop or a Kafka topic into bronze."""

import os

from jobs.common import bronze_table, parser, report, show
from tidemark.schemas import BRONZE
from tidemark.session import build_session
from tidemark.sources.kafka import auth_options
from tidemark.streaming.bronze import land_files, land_kafka

MAX_BYTES = 64 << 30


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--drop", help="directory of JSONL files")
    p.add_argument("--topic")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--max-files", type=int)
    p.add_argument("--max-bytes", type=int, default=MAX_BYTES, help="of files in a micro-batch")
    p.add_argument("--max-offsets", type=int)
    args = p.parse_args(argv)
    spark = build_session("bronze")
    table = bronze_table(args)
    if args.source == "files":
        run = land_files(spark, args.drop, table, args.checkpoint, max_files=args.max_files,
                         max_bytes=None if args.max_files else args.max_bytes)
    else:
        auth = auth_options(os.environ.get("KAFKA_USERNAME", ""), os.environ.get("KAFKA_PASSWORD", ""))
        run = land_kafka(spark, args.topic, args.bootstrap, table, args.checkpoint,
                         auth=auth, max_offsets=args.max_offsets)
    show(spark, args, BRONZE)
    report("bronze", source=args.source, rows=run.input_rows, batches=run.batches)


if __name__ == "__main__":
    main()
