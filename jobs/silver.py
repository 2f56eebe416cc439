"""Drain bronze into silver and quarantine."""

from dataclasses import asdict

from jobs.common import bronze_table, day_notes, parser, report, show, table
from tidemark.schemas import DLQ, SILVER
from tidemark.session import build_session
from tidemark.streaming.silver import silver_job

MAX_BYTES = 64 << 30


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--checkpoint", required=True, help="a new one rebuilds from all of bronze")
    p.add_argument("--bronze", help="bronze directory or table; default under --root")
    p.add_argument("--max-files", type=int)
    p.add_argument("--max-bytes", type=int, default=MAX_BYTES, help="of files in a micro-batch")
    p.add_argument("--keys-keep-partition", action="store_true",
                   help="trust that an event id never changes its day")
    args = p.parse_args(argv)
    spark = build_session("silver")
    run = silver_job(
        spark, args.bronze or bronze_table(args),
        table(spark, args, SILVER), table(spark, args, DLQ), args.checkpoint,
        max_files=args.max_files, max_bytes=None if args.max_files else args.max_bytes,
        keys_keep_partition=args.keys_keep_partition, notes=day_notes(spark, args),
    )
    show(spark, args, SILVER, DLQ)
    for batch in run.batches:
        report("silver", **asdict(batch))
    report("silver", rows=run.run.input_rows, batches=run.run.batches)


if __name__ == "__main__":
    main()
