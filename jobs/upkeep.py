"""Compact small files of the tables, and prune expired rows."""

import datetime as dt

from jobs.common import parser, report, show, table
from tidemark.schemas import BRONZE, CATEGORY_TRENDS, DLQ, RATING_DRIFT, SILVER
from tidemark.session import build_session
from tidemark.tables.upkeep import compact, compact_landed, prune


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--target-mb", type=int, default=128)
    p.add_argument("--ttl-hours", type=float, help="prune silver and quarantine rows older than this")
    p.add_argument("--bronze-ttl-hours", type=float, help="prune bronze rows landed before this")
    args = p.parse_args(argv)
    if args.format != "parquet":
        raise SystemExit("upkeep is for parquet tables; a format with MERGE brings its own")
    spark = build_session("upkeep")
    silver, dlq = table(spark, args, SILVER), table(spark, args, DLQ)
    bronze, now = table(spark, args, BRONZE), dt.datetime.now(dt.timezone.utc)
    for t, hours in ((silver, args.ttl_hours), (dlq, args.ttl_hours), (bronze, args.bronze_ttl_hours)):
        if hours is not None:
            dropped, rewritten = prune(t, t.spec.day_of[1], dt.timedelta(hours=hours), now)
            report("prune", table=t.spec.full_name, dropped=len(dropped), rewritten=len(rewritten))
    report("compact", table=BRONZE.full_name, partitions=len(compact_landed(bronze, args.target_mb)))
    for t in (silver, dlq, table(spark, args, RATING_DRIFT), table(spark, args, CATEGORY_TRENDS)):
        report("compact", table=t.spec.full_name, partitions=len(compact(t, args.target_mb)))
    show(spark, args, BRONZE, SILVER, DLQ, RATING_DRIFT, CATEGORY_TRENDS)


if __name__ == "__main__":
    main()
