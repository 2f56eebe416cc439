from __future__ import annotations

import json

import pytest

from helpers import MISSING, bronze, envelope
from tidemark.functions.rules import ENVELOPE_RULES, PAYLOAD_RULES, Record
from tidemark.operators.decode import decode
from tidemark.operators.quarantine import (
    CODE_PARSE,
    REASON_PARSE,
    REASON_RULES,
    classify,
    replay_dlq,
    split_classified,
    to_dlq,
)
from tidemark.operators.validate import annotate_failures, failure_details, failure_summary

CASES = {
    "good": (envelope(), []),
    "id": (envelope(business_id=""), ["missing_business_id"]),
    "id null": (envelope(business_id=None), ["missing_business_id"]),
    "name tabs": (envelope(name="\t  "), ["missing_name"]),
    "name non-ascii": (envelope(name="é"), []),
    "event id": (envelope(event_id=" "), ["missing_event_id"]),
    "observed": (envelope(observed_at="garbage"), ["missing_observed_at"]),
    "rating": (envelope(rating=6.5), ["rating_out_of_range"]),
    "half step": (envelope(rating=2.7), ["rating_out_of_range"]),
    "rating zero": (envelope(rating=0.5), ["rating_out_of_range"]),
    "rating null": (envelope(rating=None), ["missing_rating"]),
    "rating absent": (envelope(rating=MISSING), ["missing_rating"]),
    "rating text": (envelope(rating="good"), ["bad_rating_type"]),
    "rating quoted": (envelope(rating="2.5"), ["bad_rating_type"]),
    "rating int": (envelope(rating=4), []),
    "count": (envelope(review_count=-12), ["negative_review_count"]),
    "count null": (envelope(review_count=None), ["missing_review_count"]),
    "count float": (envelope(review_count=10.0), ["bad_review_count_type"]),
    "count huge": (envelope(review_count=99999999999), ["bad_review_count_type"]),
    "latitude": (envelope(coordinates__latitude=-91.5), ["latitude_out_of_range"]),
    "longitude": (envelope(coordinates__longitude=181.25), ["longitude_out_of_range"]),
    "no latitude": (
        envelope(coordinates__latitude=None, coordinates__longitude=999.0),
        ["missing_coordinates", "longitude_out_of_range"],
    ),
    "coordinates text": (envelope(coordinates="x"), ["missing_coordinates"]),
    "city": (envelope(location__city=""), ["missing_city"]),
    "categories": (envelope(categories=[]), ["missing_categories"]),
    "categories text": (envelope(categories="x"), ["missing_categories"]),
    "category null": (envelope(categories=["a", None]), ["bad_category_value"]),
    "category blank": (envelope(categories=[" ", "b"]), ["bad_category_value"]),
    "category number": (envelope(categories=["a", 5]), ["bad_category_value"]),
    "category object": (envelope(categories=[{"a": 1}]), ["bad_category_value"]),
    "category digits": (envelope(categories=["5"]), []),
    "category lines": (envelope(categories=["a\n\nb"]), []),
    "unknown member": (envelope(shoe_size=44), []),
    "not json": ("not json", [CODE_PARSE]),
    "truncated": (envelope()[:-20], [CODE_PARSE]),
    "empty": ("", [CODE_PARSE]),
    "blank": ("  ", [CODE_PARSE]),
    "null": (None, [CODE_PARSE]),
    "array": ("[1, 2]", [CODE_PARSE]),
    "array of envelopes": (f"[{envelope()}]", [CODE_PARSE]),
    "scalar": ("5", [CODE_PARSE]),
    "two envelopes": (envelope() + envelope(), [CODE_PARSE]),
    "two lines": (envelope() + "\n" + envelope(), [CODE_PARSE]),
    "text after": (envelope() + " xyz", [CODE_PARSE]),
    "brace after": (envelope() + "}", [CODE_PARSE]),
    "list after": (envelope() + "," + envelope(), [CODE_PARSE]),
    "braces in a name": (envelope(name="a } b {{ c"), []),
    "space after": (envelope() + " \n", []),
    "payload text": (
        json.dumps({"event_id": "e", "observed_at": "2026-01-01", "payload": "x"}),
        ["missing_business_id", "missing_name", "missing_rating", "missing_review_count",
         "missing_coordinates", "missing_city", "missing_categories"],
    ),
}


@pytest.fixture(scope="module")
def codes(spark):
    names = list(CASES)
    rows = classify(bronze(spark, [CASES[n][0] for n in names])).collect()
    return {names[r["kafka_offset"]]: r for r in rows}


@pytest.mark.parametrize("name", list(CASES))
def test_codes(codes, name):
    expected = CASES[name][1]
    row = codes[name]
    assert row["failure_codes"] == expected
    if expected == [CODE_PARSE]:
        assert row["failure_reason"] == REASON_PARSE
    else:
        assert row["failure_reason"] == (REASON_RULES if expected else None)


#: One way to break each rule; rules about one field exclude each other.
BREAKS = {
    "missing_event_id": {"event_id": ""}, "missing_observed_at": {"observed_at": "soon"},
    "missing_business_id": {"business_id": None}, "missing_name": {"name": ""},
    "missing_rating": {"rating": MISSING}, "bad_rating_type": {"rating": True}, "rating_out_of_range": {"rating": 5.5},
    "missing_review_count": {"review_count": MISSING}, "bad_review_count_type": {"review_count": "few"},
    "negative_review_count": {"review_count": -2}, "missing_coordinates": {"coordinates": None},
    "latitude_out_of_range": {"coordinates__latitude": -91}, "longitude_out_of_range": {"coordinates__longitude": 181.5},
    "missing_city": {"location__city": MISSING}, "missing_categories": {"categories": None},
    "bad_category_value": {"categories": ["", "b"]},
}


def _together(one: str, two: str) -> bool:
    fields = [{k.split("__")[0] for k in BREAKS[c]} for c in (one, two)]
    both = {"latitude_out_of_range", "longitude_out_of_range"} == {one, two}
    return both or not fields[0] & fields[1]


def test_every_pair_of_rules_accumulates_in_rule_order(spark):
    order = [r.code for r in ENVELOPE_RULES]
    assert sorted(BREAKS) == sorted(order)
    pairs = [(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if _together(a, b)]
    texts = [envelope(**{**BREAKS[a], **BREAKS[b]}) for a, b in pairs]
    rows = classify(bronze(spark, texts)).orderBy("kafka_offset").collect()
    assert [tuple(r["failure_codes"]) for r in rows] == pairs


@pytest.mark.parametrize(("value", "kind"), [("good", "str"), ([1], "list"), ({"a": 1}, "dict")])
def test_the_message_names_the_type_of_a_bad_rating(spark, value, kind):
    row = failure_details(decode(bronze(spark, [envelope(rating=value)]))).first()
    assert [f["message"] for f in row["failures"]] == [f"rating must be numeric, got {kind}"]


def test_nothing_is_dropped(spark):
    frame = classify(bronze(spark, [t for t, _ in CASES.values()]))
    valid, quarantined = split_classified(frame)
    assert valid.count() + quarantined.count() == len(CASES)


def test_details_name_the_element_and_the_value(spark):
    text = envelope(categories=["a", None, 5, " "], rating=9.9, review_count=-3)
    frame = failure_summary(failure_details(decode(bronze(spark, [text]))))
    row = frame.select("failures", "failure_summary").first()
    messages = {f["field"]: f["message"] for f in row["failures"]}
    assert messages["rating"] == "rating=9.9 outside 1.0..5.0 in 0.5 increments"
    assert messages["review_count"] == "review_count=-3 is negative"
    assert row["failure_summary"] == (
        "rating_out_of_range:rating,negative_review_count:review_count,"
        "bad_category_value:categories[1],bad_category_value:categories[2],"
        "bad_category_value:categories[3]"
    )


def test_valid_row_has_empty_details(spark):
    row = failure_summary(failure_details(decode(bronze(spark, [envelope()])))).first()
    assert row["failures"] == [] and row["failure_summary"] == ""


def test_rules_run_on_other_column_names(spark):
    frame = spark.sql("""SELECT 'x' AS id, 'n' AS label, 4.0D AS stars, 3 AS reviews,
        1.0D AS lat, 2.0D AS lon, '' AS town, array('a') AS tags""")
    record = Record("id", "label", "stars", "reviews", "lat", "lon", "town", "tags")
    assert annotate_failures(frame, PAYLOAD_RULES, record).first()["failure_codes"] == [
        "missing_city"
    ]


def test_dlq_key_separates_null_parts(spark):
    frame = spark.sql("""SELECT * FROM VALUES
        (null, 't', 1, 2L, 'k', array('c'), 'x'), (null, null, 1, 2L, 'k', array('c'), 'tx')
        AS v(ingest_ts, kafka_topic, kafka_partition, kafka_offset, kafka_key,
             failure_codes, raw_envelope)""")
    keys = {r["dlq_key"] for r in to_dlq(frame, "r").collect()}
    assert len(keys) == 2 and all(len(k) == 64 for k in keys)


def test_replay_applies_the_rules_of_today(spark):
    texts = [envelope("a", rating=9.9), envelope("b", rating=9.9, name=""), "junk"]
    dlq = split_classified(classify(bronze(spark, texts)))[1]
    rules = [r for r in PAYLOAD_RULES if r.code != "rating_out_of_range"]
    again = {r["kafka_offset"]: r["failure_reason"] for r in replay_dlq(dlq, rules).collect()}
    assert again == {0: None, 1: REASON_RULES, 2: REASON_PARSE}


def test_row_is_parsed_once(spark):
    """A filter on the outcome must not be pulled below the parse."""
    valid = split_classified(classify(bronze(spark, [envelope()])))[0]
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)
