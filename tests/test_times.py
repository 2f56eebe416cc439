from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.times import (
    instant_literal,
    lag_ms,
    to_utc,
    utc_day,
    utc_iso,
    utc_midnight,
    utc_wall_clock,
)

TEXTS = {
    "2026-01-01T12:00:00": "2026-01-01 12:00:00",
    "2026-01-01 12:00:00.25": "2026-01-01 12:00:00.25",
    "2026-01-01T12:00:00Z": "2026-01-01 12:00:00",
    "2026-01-01T12:00:00+02:00": "2026-01-01 10:00:00",
    "2026-01-01T12:00:00-05:30": "2026-01-01 17:30:00",
    "2026-01-01": "2026-01-01 00:00:00",
    "2026-06-09T12:00:00.000+00:00": "2026-06-09 12:00:00",
    "12:00:00": None,
    "12:00:00+00:00": None,
    "garbage": None,
    "": None,
    "2026-13-01T00:00:00": None,
}


@pytest.mark.parametrize("text,expected", TEXTS.items())
def test_to_utc(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").selectExpr(
        f"{to_utc('t')} AS i"
    ).selectExpr(f"cast({utc_wall_clock('i')} AS string) AS w").first()
    assert row["w"] == expected


def test_day_is_utc_in_any_session_zone(spark):
    frame = spark.sql("SELECT timestamp'2026-01-02 01:00:00Z' AS t")
    assert frame.selectExpr(f"{utc_day('t')} AS d").first()["d"] == dt.date(2026, 1, 2)


def test_repeated_hour_stays_apart(spark):
    frame = spark.sql("""SELECT explode(array(timestamp'2024-11-03 05:30:00Z',
        timestamp'2024-11-03 06:30:00Z')) AS t""")
    rows = frame.selectExpr(f"{utc_iso('t')} AS s").collect()
    assert sorted(r["s"] for r in rows) == [
        "2024-11-03T05:30:00.000000+00:00", "2024-11-03T06:30:00.000000+00:00"
    ]


@settings(max_examples=15, deadline=None)
@given(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)))
def test_literals_and_days_agree_with_python(spark, moment):
    literal = instant_literal(moment.replace(tzinfo=dt.timezone.utc))
    row = spark.sql(f"""SELECT {utc_day(literal)} AS d, {utc_wall_clock(literal)} AS w,
        {utc_midnight(moment.date())} <= {literal} AS after""").first()
    assert row["d"] == moment.date() and row["w"] == moment and row["after"]


def test_lag_truncates_and_never_goes_negative(spark):
    frame = spark.sql("""SELECT timestamp_micros(1999999) AS later,
        timestamp_micros(1000000) AS earlier""")
    row = frame.selectExpr(
        f"{lag_ms('later', 'earlier')} AS a", f"{lag_ms('earlier', 'later')} AS b"
    ).first()
    assert (row["a"], row["b"]) == (999, 0)


def test_lag_of_many_days_is_not_cut(spark):
    frame = spark.sql("SELECT timestamp'2024-03-01 00:00:00Z' AS later, timestamp'2023-03-01 00:00:00Z' AS earlier")
    assert frame.selectExpr(f"{lag_ms('later', 'earlier')} AS a").first()["a"] == 366 * 86_400_000
