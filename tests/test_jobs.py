"""The mains, end to end over one root directory, and the registered queries."""

from __future__ import annotations

import json

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import statements
from checks.queries import registry
from helpers import envelope
from jobs import bootstrap, bronze, gold, ingest, replay, silver, upkeep
from tidemark.session import workspace

SMALL = "/root/testdata/sf0.001"


def test_mains_run_in_sequence(spark, capsys):
    root = workspace(spark, "jobs")
    texts = [envelope("a"), envelope("b", rating=4.0), envelope("c", rating=9.0), "junk"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{root}/drop")
    bootstrap.main(["--root", root])
    bronze.main(["--root", root, "--source", "files", "--drop", f"{root}/drop",
                 "--checkpoint", f"{root}/cp-b"])
    for name in ("cp-s", "cp-s2"):
        silver.main(["--root", root, "--checkpoint", f"{root}/{name}"])
    gold.main(["--root", root, "--today", "2026-06-09"])
    gold.main(["--root", root, "--today", "2026-07-09"])
    upkeep.main(["--root", root])
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    reports = {job: [r for r in lines if r["job"] == job] for job in ("bronze", "silver", "gold")}
    assert reports["bronze"][0]["rows"] == 4
    assert [(r["valid"], r["dlq"]) for r in reports["silver"] if "valid" in r] == [(2, 2)] * 2
    first, second = reports["gold"]
    assert (first["rating_drift_rows"], first["category_trends_rows"]) == (1, 2)
    assert second["skipped"] and second["as_of"] == "2026-07-08"
    rows = {"bronze.business_events_raw": 4, "silver.business_events": 2, "dlq.business": 2,
            "gold.rating_drift_daily": 1, "gold.category_trends_daily": 2}
    for name, count in rows.items():
        assert spark.table(name).count() == count, name
        spark.sql(f"DROP TABLE {name}")


def test_ingest_main(spark, capsys):
    root = workspace(spark, "ingest")
    good = {"id": "b1", "name": "n", "rating": 4, "review_count": 1, "categories": [{"alias": "a"}],
            "coordinates": {"latitude": 1, "longitude": 2}, "location": {"city": "c"}}
    bodies = [json.dumps({"businesses": [good, {"id": 5}]}), "broken", '{"businesses": []}']
    spark.createDataFrame([(b,) for b in bodies], "body string").selectExpr(
        "body", "'t' AS search_term", "'l' AS search_location", "timestamp'2026-06-09 12:00:00Z' AS fetched_at",
    ).write.parquet(f"{root}/pages")
    ingest.main(["--pages", f"{root}/pages", "--producer-id", "p", "--source", "s", "--raw-topic", "raw",
                 "--dlq-topic", "dlq", "--out", f"{root}/out", "--failed-topic", "failed"])
    line = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (line["pages_fetched"], line["businesses_seen"], line["accepted"], line["rejected"]) == (3, 2, 1, 1)
    assert line["failed_pages"] == line["cities_attempted"] == 1
    assert spark.read.json(f"{root}/out/topic=failed").first()["body"] == "broken"
    assert spark.read.text(f"{root}/out/topic=raw").count() == spark.read.text(f"{root}/out/topic=dlq").count() == 1


def test_replay_main(spark, capsys):
    root = workspace(spark, "replay")
    spark.createDataFrame([(envelope("a", rating=9.0),), ("junk",)], "value string").write.text(f"{root}/drop")
    bronze.main(["--root", root, "--source", "files", "--drop", f"{root}/drop", "--checkpoint", f"{root}/cp-b"])
    silver.main(["--root", root, "--checkpoint", f"{root}/cp-s"])
    replay.main(["--root", root, "--code", "rating_out_of_range"])
    line = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert line == {"job": "replay", "rescued": 0, "days": []}


def test_bootstrap_main_sets_properties(spark):
    root = workspace(spark, "bootstrap")
    bootstrap.main(["--root", root, "--property", "team=listings", "--property", "tier=raw"])
    for name in ("bronze.business_events_raw", "silver.business_events", "dlq.business",
                 "gold.rating_drift_daily", "gold.category_trends_daily"):
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        assert found["team"] == "listings" and found["tier"] == "raw"
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(SystemExit):
        bootstrap.main(["--root", root, "--property", "nonsense"])


def test_other_formats_need_a_name(spark):
    with pytest.raises(SystemExit):
        bronze.main(["--source", "files", "--drop", "d", "--checkpoint", "c"])
    with pytest.raises(SystemExit):
        upkeep.main(["--format", "delta", "--catalog", "c"])


def test_root_is_required_for_parquet(spark):
    with pytest.raises(SystemExit):
        gold.main(["--today", "2026-06-09"])


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(registry()) == set(statements())
    assert set(registry()) <= set(contract.queries()) and set(statements()) <= set(contract.oracle_sql())


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry()))
def test_query_equals_its_counterpart(spark, oracle, name):
    assert difference(spark, oracle, name, SMALL) is None
