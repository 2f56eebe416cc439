from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helpers import MISSING
from tidemark.operators.envelope import REASON_NORMALIZE, outcomes
from tidemark.operators.normalize import normalize
from tidemark.plans.ingest import ingest, ingest_pass
from tidemark.sources.pages import explode_listings, failed_pages

GOOD = {
    "id": "biz-1",
    "name": "Lantern & Page",
    "url": "https://example.net/lantern",
    "is_closed": False,
    "rating": 3.5,
    "review_count": 37,
    "categories": [{"alias": "bookstores", "title": "Bookshops"}],
    "coordinates": {"latitude": 63.43, "longitude": 10.395},
    "location": {"address1": "Kaigata 9", "city": "Trondheim", "zip_code": "7010"},
    "transactions": ["pickup"],
    "distance": 803.25,
}


def listing(**changes) -> dict:
    doc = {**GOOD, **{k: v for k, v in changes.items() if v is not MISSING}}
    return {k: v for k, v in doc.items() if changes.get(k) is not MISSING}


def pages(spark, *bodies):
    rows = [(b if isinstance(b, str) else json.dumps(b), i) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "body string, page_no int").selectExpr(
        "*", "'bookshops' AS search_term", "'Harbour Quarter' AS search_location",
        "timestamp'2026-06-09 12:00:00Z' AS fetched_at",
    )


def one_page(spark, *listings):
    return pages(spark, {"total": len(listings), "businesses": list(listings)})


def test_pages_without_listings_yield_none(spark):
    frame = pages(spark, {"businesses": []}, {"total": 0}, {"businesses": None}, "junk",
                  {"businesses": [listing()]})
    rows = explode_listings(frame).collect()
    assert [(r["page_no"], r["position"]) for r in rows] == [(4, 0)]


def test_a_pass_parses_each_body_once(spark):
    frame = pages(spark, {"businesses": []}, "junk", {"businesses": [listing(), listing(id=MISSING)]}, "{", {"total": 0})
    sweep = ingest_pass(frame, "p", "s", "raw", "dlq", "failed")
    plan = sweep.records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(businesses") == 1
    rows = sweep.records.collect()
    assert sorted(r["topic"] for r in rows) == ["dlq", "failed", "failed", "raw"]
    assert sorted(json.loads(r["value"])["body"] for r in rows if r["topic"] == "failed") == ["junk", "{"]
    assert sweep.totals() == {"cities_attempted": 1, "pages_fetched": 5, "failed_pages": 2, "businesses_seen": 2,
                              "accepted": 1, "rejected": 1}
    apart = ingest(frame, "p", "s", "raw", "dlq")
    assert sorted(map(tuple, apart.records.select("topic", "key").collect())) == sorted(
        (r["topic"], r["key"]) for r in rows if r["topic"] != "failed")


def test_broken_pages_are_told(spark):
    whole = json.dumps({"businesses": [listing()]})
    frame = pages(spark, {"businesses": []}, {"total": 0}, {"businesses": None}, "junk", whole, whole[:-9],
                  {"businesses": "none"}, "[]", "")
    failed = failed_pages(frame).collect()
    assert sorted(r["page_no"] for r in failed) == [3, 5, 6, 7, 8]
    assert {r["body"] for r in failed} >= {"junk", whole[:-9]}


def test_report_of_searches_without_a_term(spark):
    frame = one_page(spark, listing()).withColumn("search_term", F.lit(None).cast("string"))
    report = ingest(frame, "p1", "src", "raw", "dlq").report.collect()
    got = {r["is_total"]: (r["pages_fetched"], r["businesses_seen"], r["accepted"]) for r in report}
    assert len(report) == 2 and got == {False: (1, 1, 1), True: (1, 1, 1)}


# (change, expected payload members) or (change, None) for a failure
NORMALISE = {
    "good": ({}, {"business_id": "biz-1", "categories": ["bookstores"], "rating": 3.5}),
    "sparse": (
        {"url": MISSING, "transactions": MISSING, "is_closed": MISSING},
        {"url": None, "transactions": [], "is_closed": None},
    ),
    "no name": ({"name": MISSING}, {"name": ""}),
    "null name": ({"name": None}, None),
    "name number": ({"name": 5}, None),
    "no id": ({"id": MISSING}, None),
    "null id": ({"id": None}, None),
    "id number": ({"id": 5}, None),
    "url number": ({"url": 5}, None),
    "city number": ({"location": {"city": 5}}, None),
    "quoted rating": ({"rating": "2.5"}, {"rating": 2.5}),
    "word rating": ({"rating": "great"}, None),
    "suffixed rating": ({"rating": "2.5d"}, None),
    "bool rating": ({"rating": True}, {"rating": 1.0}),
    "integral count": ({"review_count": 10.0}, {"review_count": 10}),
    "quoted count": ({"review_count": "10"}, {"review_count": 10}),
    "fractional count": ({"review_count": 10.5}, None),
    "closed word": ({"is_closed": "Yes"}, {"is_closed": True}),
    "closed number": ({"is_closed": 0}, {"is_closed": False}),
    "closed other": ({"is_closed": 2}, None),
    "null nested": (
        {"coordinates": None, "location": None, "categories": None, "transactions": None},
        {"categories": [], "transactions": []},
    ),
    "coordinates list": ({"coordinates": [1, 2]}, None),
    "alias empty": ({"categories": [{"alias": ""}, {"title": "x"}, {"alias": "b"}]},
                    {"categories": ["b"]}),
    "alias number": ({"categories": [{"alias": 5}]}, None),
    "category text": ({"categories": ["tea"]}, None),
    "category null": ({"categories": [None, {"alias": "a"}]}, None),
    "categories text": ({"categories": "tea"}, None),
    "transaction number": ({"transactions": [5]}, None),
    "transaction null": ({"transactions": [None]}, None),
    "quote in name": ({"name": 'The "id": 5 Bar'}, {"name": 'The "id": 5 Bar'}),
    "escaped": ({"name": "café"}, {"name": "café"}),
}


@pytest.fixture(scope="module")
def normalised(spark):
    frame = one_page(spark, *[listing(**c) for c, _ in NORMALISE.values()])
    rows = normalize(explode_listings(frame)).collect()
    return dict(zip(NORMALISE, sorted(rows, key=lambda r: r["position"]), strict=True))


@pytest.mark.parametrize("name", list(NORMALISE))
def test_normalise(normalised, name):
    expected, row = NORMALISE[name][1], normalised[name]
    assert row["normalize_failed"] == (expected is None)
    for key, value in (expected or {}).items():
        assert row["payload"][key] == value
    if name == "good":
        assert row["payload"]["location"]["city"] == "Trondheim"
        assert row["payload"]["coordinates"]["latitude"] == 63.43
        assert row["payload"]["search_term"] == "bookshops"


def test_escaped_member_name_is_not_missed(spark):
    body = '{"businesses":[{"\\u0069d":5,"name":"x"}]}'
    row = normalize(explode_listings(pages(spark, body))).first()
    assert row["normalize_failed"]


def test_sweep(spark):
    frame = one_page(
        spark, listing(), listing(id="x", rating=7.0, review_count=-5), listing(id=5),
        listing(id=MISSING),
    )
    sweep = ingest(frame, "p1", "src", "raw", "dlq",
                   now="timestamp'2026-06-09 12:00:00.250Z'")
    (raw,) = sweep.records.filter("topic = 'raw'").collect()
    envelope = json.loads(raw["value"])
    assert (raw["topic"], raw["key"]) == ("raw", "biz-1")
    assert envelope["observed_at"] == "2026-06-09T12:00:00.000000+00:00"
    assert envelope["ingest_lag_ms"] == 250 and envelope["schema_version"] == 1
    assert envelope["payload"]["price"] is None
    assert len(envelope["event_id"]) == 36

    dlq = {r["key"]: json.loads(r["value"]) for r in sweep.records.filter("topic = 'dlq'").collect()}
    assert set(dlq) == {"x", "5", "unknown"}
    assert dlq["x"]["reason"] == "pre_publish_validation"
    assert [f["code"] for f in dlq["x"]["failures"]] == [
        "rating_out_of_range", "negative_review_count"
    ]
    assert dlq["5"]["reason"] == REASON_NORMALIZE and dlq["5"]["failures"] == []
    assert dlq["5"]["payload"]["id"] == 5

    total = sweep.report.filter("search_location IS NULL").first()
    assert (total["businesses_seen"], total["accepted"], total["rejected"]) == (4, 1, 3)


def test_two_good_listings_are_accepted(spark):
    frame = one_page(spark, listing(), listing(id="biz-2", rating=3.5, transactions=[]))
    report = ingest(frame, "p", "s", "raw", "dlq").report.filter("search_location IS NOT NULL")
    row = report.first()
    assert (row["businesses_seen"], row["accepted"], row["rejected"]) == (2, 2, 0)


def test_event_ids_repeat_with_the_input_and_differ_by_position(spark):
    frame = one_page(spark, listing(), listing())

    def ids():
        rows = ingest(frame, "p", "s", "raw", "dlq").records.collect()
        return {json.loads(r["value"])["event_id"] for r in rows}

    assert len(ids()) == 2 and ids() == ids()


def test_failed_listing_has_no_failures(spark):
    row = outcomes(normalize(explode_listings(one_page(spark, listing(id=5))))).first()
    assert row["reason"] == REASON_NORMALIZE and row["failures"] == []
