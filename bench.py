"""Headline timings over the events table; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS``
(default 8). Each job runs on stored input, as it would in production: the recipe's
bronze rows are written once, untimed, and every stage reads the stage before.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from tidemark import recipe  # noqa: E402
from tidemark.operators import gold, reports  # noqa: E402
from tidemark.operators.quarantine import classify, split_classified  # noqa: E402
from tidemark.operators.silver import latest_observations, with_day  # noqa: E402
from tidemark.plans.gold import gold_job  # noqa: E402
from tidemark.plans.ingest import ingest  # noqa: E402
from tidemark.schemas import CATEGORY_TRENDS, DLQ, RATING_DRIFT, SILVER  # noqa: E402
from tidemark.session import build_session, workspace  # noqa: E402
from tidemark.sources.files import write_jsonl  # noqa: E402
from tidemark.streaming.bronze import land_files  # noqa: E402
from tidemark.streaming.silver import process_batch  # noqa: E402
from tidemark.tables.parquet import ParquetTable  # noqa: E402

TODAY = dt.date.fromisoformat(recipe.TODAY)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = workspace(spark, "bench")
    bronze_dir, drop = f"{root}/bronze", f"{root}/drop"
    rows = recipe.bronze(spark, sf_dir).repartition(int(cpus))
    rows.write.parquet(bronze_dir)
    write_jsonl(rows, drop, "raw_envelope")
    pages_dir = f"{root}/pages"
    recipe.pages(spark, sf_dir).repartition(int(cpus)).write.parquet(pages_dir)

    silver = ParquetTable(spark, f"{root}/silver", SILVER)
    dlq = ParquetTable(spark, f"{root}/dlq", DLQ)
    drift = ParquetTable(spark, f"{root}/drift", RATING_DRIFT)
    trends = ParquetTable(spark, f"{root}/trends", CATEGORY_TRENDS)

    def bronze() -> DataFrame:
        return spark.read.parquet(bronze_dir)

    def sweep(part: str) -> DataFrame:
        return getattr(ingest(spark.read.parquet(pages_dir), "p1", "events", "raw", "dlq"), part)

    # In order: later jobs read the tables earlier ones wrote.
    jobs: dict[str, Callable[[], object]] = {
        "bronze_drain": lambda: land_files(spark, drop, f"{root}/landed", f"{root}/cp"),
        "decode_rules_split": lambda: drain(classify(bronze())),
        "silver_dedup": lambda: drain(
            with_day(latest_observations(split_classified(classify(bronze()))[0]))
        ),
        "silver_first_load": lambda: process_batch(bronze(), silver, dlq),
        "silver_full_replay": lambda: process_batch(bronze(), silver, dlq),
        "silver_replay_pinned_days": lambda: process_batch(
            bronze(), silver, dlq, keys_keep_partition=True
        ),
        "rating_drift_all_days": lambda: drain(gold.rating_drift_daily(silver.read())),
        "category_trends_all_days": lambda: drain(gold.category_trends_daily(silver.read())),
        "gold_job_all_days": lambda: gold_job(silver.read(), drift, trends, TODAY, days=None),
        "gold_job_window": lambda: gold_job(silver.read(), drift, trends, TODAY),
        "dlq_by_reason_code": lambda: drain(reports.dlq_by_reason_code(dlq.read())),
        "trending_rollup": lambda: drain(reports.trending_rollup(trends.read(), TODAY)),
        "ingest_records": lambda: drain(sweep("records")),
        "sweep_report": lambda: drain(sweep("report")),
    }
    seconds: dict[str, float] = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
