"""Recompute the recent days of the gold tables."""

import datetime as dt
from dataclasses import asdict

from jobs.common import day_notes, parser, report, show, table, today_utc
from tidemark.plans.gold import gold_job
from tidemark.schemas import CATEGORY_TRENDS, RATING_DRIFT, SILVER
from tidemark.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("--days", type=int, default=2)
    p.add_argument("--today", type=dt.date.fromisoformat, help="UTC date; default now")
    p.add_argument("--cap-at-today", action="store_true", help="leave out future-dated rows")
    args = p.parse_args(argv)
    spark = build_session("gold")
    result = gold_job(
        table(spark, args, SILVER).read(), table(spark, args, RATING_DRIFT),
        table(spark, args, CATEGORY_TRENDS), args.today or today_utc(), args.days,
        args.cap_at_today, day_notes(spark, args),
    )
    show(spark, args, RATING_DRIFT, CATEGORY_TRENDS)
    report("gold", **asdict(result))


if __name__ == "__main__":
    main()
