"""Check quarantined rows again under the rules of today; what passes goes to silver."""

from dataclasses import asdict

from jobs.common import day_notes, parser, report, show, table
from tidemark.plans.replay import replay_job
from tidemark.schemas import DLQ, SILVER
from tidemark.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--code", action="append", help="only rows that failed for this rule; may be repeated")
    args = p.parse_args(argv)
    if args.format != "parquet":
        raise SystemExit("replay is for parquet tables")
    spark = build_session("replay")
    result = replay_job(table(spark, args, SILVER), table(spark, args, DLQ), codes=args.code, notes=day_notes(spark, args))
    show(spark, args, SILVER, DLQ)
    report("replay", **asdict(result))


if __name__ == "__main__":
    main()
