"""The validation rules: one table that serves both the publish and the silver side.

A rule is SQL text over named fields. A :class:`Record` says where each field is
found, so the same rules run on a decoded envelope, on a normalised payload, or on
any frame with other names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from tidemark.functions.text import is_blank, quoted
from tidemark.schemas import FAILURES


@dataclass(frozen=True)
class Record:
    """Where a rule finds each field, and which fields held a wrongly typed value."""

    business_id: str
    name: str
    rating: str
    review_count: str
    latitude: str
    longitude: str
    city: str
    categories: str
    event_id: str = "NULL"
    observed_at: str = "NULL"
    rating_mistyped: str = "false"
    # Name of the type a mistyped rating has.
    rating_kind: str = "'null'"
    review_count_mistyped: str = "false"
    # Positions of category elements that were not JSON strings.
    categories_mistyped: str = "cast(array() AS array<int>)"

    @classmethod
    def of_payload(cls, payload: str, **extra: str) -> Record:
        return cls(
            business_id=f"{payload}.business_id",
            name=f"{payload}.name",
            rating=f"{payload}.rating",
            review_count=f"{payload}.review_count",
            latitude=f"{payload}.coordinates.latitude",
            longitude=f"{payload}.coordinates.longitude",
            city=f"{payload}.location.city",
            categories=f"{payload}.categories",
            **extra,
        )


@dataclass(frozen=True)
class Rule:
    """``fails`` must never be null; ``message`` is evaluated for failing rows only."""

    code: str
    field: str
    fails: str
    message: str
    # Positions of the offending elements, for a rule about array elements.
    positions: str = ""

    def bound(self, record: Record) -> Rule:
        """The rule with its fields filled in."""
        where = asdict(record)
        return Rule(
            self.code,
            self.field,
            f"({self.fails.format(**where)})",
            self.message.format(**where),
            self.positions.format(**where),
        )


# Rounded half up to one decimal, then one of 1.0, 1.5 .. 5.0.
_ON_SCALE = (
    "round({rating}, 1) BETWEEN 1.0 AND 5.0 "
    "AND round({rating}, 1) * 2 = floor(round({rating}, 1) * 2)"
)
# Null, blank or not a JSON string.
_BAD_POSITIONS = (
    "filter(transform({categories}, (c, i) -> CASE WHEN "
    + is_blank("c")
    + " OR array_contains({categories_mistyped}, i) THEN i END), i -> i IS NOT NULL)"
)
# An element can only be blank if the joined text has an empty-looking line; the
# exact, slower look at each element runs for such rows only.
_BAD_CATEGORY = (
    "coalesce((array_join({categories}, '\\n', '') RLIKE r'(?U)(^|\\n)\\s*(\\n|$)' "
    "OR size({categories_mistyped}) > 0) AND size(" + _BAD_POSITIONS + ") > 0, false)"
)

# Codes, fields and message texts are fixed values.
PAYLOAD_RULES: tuple[Rule, ...] = (
    Rule("missing_business_id", "business_id", is_blank("{business_id}"),
         "'business_id must be a non-empty string'"),
    Rule("missing_name", "name", is_blank("{name}"),
         "'name must be a non-empty string'"),
    Rule("missing_rating", "rating", "{rating} IS NULL AND NOT {rating_mistyped}",
         "'rating is required'"),
    Rule("bad_rating_type", "rating", "{rating_mistyped}",
         "concat('rating must be numeric, got ', coalesce({rating_kind}, 'null'))"),
    Rule("rating_out_of_range", "rating", "{rating} IS NOT NULL AND NOT (" + _ON_SCALE + ")",
         "concat('rating=', {rating}, ' outside 1.0..5.0 in 0.5 increments')"),
    Rule("missing_review_count", "review_count",
         "{review_count} IS NULL AND NOT {review_count_mistyped}",
         "'review_count is required'"),
    Rule("bad_review_count_type", "review_count", "{review_count_mistyped}",
         "'review_count must be an integer'"),
    Rule("negative_review_count", "review_count",
         "{review_count} IS NOT NULL AND {review_count} < 0",
         "concat('review_count=', {review_count}, ' is negative')"),
    Rule("missing_coordinates", "coordinates", "{latitude} IS NULL OR {longitude} IS NULL",
         "'coordinates.latitude and coordinates.longitude required'"),
    # NaN sorts above every number, so it is out of range too.
    Rule("latitude_out_of_range", "coordinates.latitude",
         "{latitude} IS NOT NULL AND NOT {latitude} BETWEEN -90 AND 90",
         "concat('latitude=', {latitude}, ' not in [-90, 90]')"),
    Rule("longitude_out_of_range", "coordinates.longitude",
         "{longitude} IS NOT NULL AND NOT {longitude} BETWEEN -180 AND 180",
         "concat('longitude=', {longitude}, ' not in [-180, 180]')"),
    Rule("missing_city", "location.city", is_blank("{city}"),
         "'location.city must be a non-empty string'"),
    Rule("missing_categories", "categories",
         "{categories} IS NULL OR size({categories}) = 0",
         "'categories must be a non-empty list'"),
    Rule("bad_category_value", "categories", _BAD_CATEGORY,
         "'each category must be a non-empty string'", positions=_BAD_POSITIONS),
)

# The upsert key and the day bucket must exist before anything else is looked at.
ENVELOPE_RULES: tuple[Rule, ...] = (
    Rule("missing_event_id", "event_id", is_blank("{event_id}"),
         "'event_id must be a non-empty string'"),
    Rule("missing_observed_at", "observed_at", "{observed_at} IS NULL",
         "'observed_at must be a timestamp'"),
    *PAYLOAD_RULES,
)


def failing_codes(record: Record, rules: Sequence[Rule]) -> str:
    """Codes of all rules a row breaks, in rule order; each code at most once."""
    bound = [rule.bound(record) for rule in rules]
    entries = [f"CASE WHEN {r.fails} THEN {quoted(r.code)} END" for r in bound]
    return _if_any(bound, f"array_compact(array({', '.join(entries)}))", "array<string>")


def failing_details(record: Record, rules: Sequence[Rule]) -> str:
    """``(code, field, message)`` per failure; element rules give one per element."""
    bound = [rule.bound(record) for rule in rules]
    entries = [f"CASE WHEN {r.fails} THEN {_entries(r)} END" for r in bound]
    return _if_any(bound, f"flatten(array_compact(array({', '.join(entries)})))", FAILURES)


def _entries(rule: Rule) -> str:
    def entry(field: str) -> str:
        return (
            f"named_struct('code', {quoted(rule.code)}, 'field', {field}, "
            f"'message', {rule.message})"
        )

    if not rule.positions:
        return f"array({entry(quoted(rule.field))})"
    at = f"concat({quoted(rule.field + '[')}, i, ']')"
    return f"transform({rule.positions}, i -> {entry(at)})"


def _if_any(bound: Sequence[Rule], found: str, kind: str) -> str:
    """Valid rows pay for the bare tests alone."""
    tests = " OR ".join(r.fails for r in bound)
    return f"CASE WHEN {tests} THEN {found} ELSE cast(array() AS {kind}) END"


def summarize(failures: str) -> str:
    """One line ``code:field,code:field``."""
    return f"array_join(transform({failures}, f -> concat_ws(':', f.code, f.field)), ',')"
