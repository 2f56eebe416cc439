"""UTC time arithmetic that never depends on the session time zone.

Conversions run on epoch microseconds. Going through local wall-clock time would
fold the repeated hour at the end of daylight saving.
"""

from __future__ import annotations

import datetime as dt

_MICROS_PER_DAY = 86_400_000_000
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_ZONED = r"(Z|[+-]\d{1,2}(:?\d{2})?(:\d{2})?|[A-Za-z]{2,}(/\w+)*)\s*$"
_DATED = r"^\s*[+-]?\d{4,}-\d{1,2}(-\d{1,2})?"


def to_utc(text: str) -> str:
    """ISO-8601 text to an instant: naive text is UTC, offsets are honoured.

    Null for anything that is not a dated timestamp.
    """
    clock = f"regexp_replace({text}, r'{_DATED}', '')"
    return f"""CASE
        WHEN NOT {text} RLIKE r'{_DATED}' THEN NULL
        WHEN endswith({text}, '+00:00') THEN try_to_timestamp({text})
        WHEN trim({clock}) = '' THEN try_to_timestamp(concat(trim({text}), 'T00:00:00Z'))
        WHEN {clock} RLIKE r'{_ZONED}' THEN try_to_timestamp({text})
        ELSE try_to_timestamp(concat(rtrim({text}), 'Z')) END"""


def utc_day(instant: str) -> str:
    """UTC calendar day of an instant."""
    micros = f"unix_micros({instant})"
    midnight = f"({micros} - pmod({micros}, {_MICROS_PER_DAY}L))"
    return f"date_from_unix_date(cast({midnight} div {_MICROS_PER_DAY}L AS int))"


def utc_wall_clock(instant: str) -> str:
    """UTC wall clock of an instant as TIMESTAMP_NTZ."""
    return (
        f"timestampadd(MICROSECOND, unix_micros({instant}), "
        "timestamp_ntz'1970-01-01 00:00:00')"
    )


def utc_instant(wall_clock: str) -> str:
    """Instant of a TIMESTAMP_NTZ (or naive text) read as UTC."""
    return f"try_to_timestamp(concat(cast({wall_clock} AS string), 'Z'))"


def utc_iso(instant: str) -> str:
    """ISO-8601 text in UTC with microseconds and ``+00:00``."""
    text = f"""date_format({utc_wall_clock(instant)}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
    return f"concat({text}, '+00:00')"


def instant_literal(moment: dt.datetime) -> str:
    """A zoned moment as a constant that folds and reaches the scan."""
    if moment.tzinfo is None:
        raise ValueError("the moment must carry a time zone")
    micros = (moment - _EPOCH) // dt.timedelta(microseconds=1)
    return f"timestamp_micros({micros}L)"


def utc_midnight(day: dt.date) -> str:
    """The instant at 00:00 UTC of a day."""
    return instant_literal(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc))


def lag_ms(now: str, fetched: str) -> str:
    """Whole milliseconds from fetch to now, never negative."""
    micros = f"(unix_micros({now}) - unix_micros({fetched}))"
    return f"greatest(0L, {micros} div 1000L)"
