"""Envelope text to a typed struct.

Each row is parsed once, straight into the typed schema. Only rows the parser
flagged (malformed text, a value of the wrong type) or whose categories look like
bare JSON literals are parsed a second time, to tell unparseable from mistyped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions import variants
from tidemark.functions.barrier import computed_once
from tidemark.functions.rules import Record
from tidemark.functions.text import quoted
from tidemark.functions.times import to_utc
from tidemark.functions.variants import Leaf
from tidemark.schemas import ENVELOPE

# How a number, true/false, object or array element reads once turned to text.
_LITERAL_TEXT = r"(?m)^(-?\d.*|true|false|\{.*|\[.*)$"
_FLAGGED = "(env IS NULL OR env._flagged IS NOT NULL)"
# The parser stops after the first value. Texts that may hold more behind it: something other
# than a comma or bracket after a brace, objects side by side, an end that is no brace, or braces
# that do not match (told by bytes: a brace is one, and they need not be counted one by one). The first pattern is tried at
# braces only, the second where the end is no brace.
_MORE_AFTER = r"\}\s*+([^\s,\]\}]|,\s*+\{)"
_OTHER_END = r"[^\s\}]\s*$"


def _trailing(column: str) -> str:
    """Whether anything follows the first JSON value; only suspects are parsed once more."""
    braces = " <> ".join(f"octet_length(replace({column}, '{b}', ''))" for b in "{}")
    end = f"(NOT endswith({column}, '}}') AND {column} RLIKE r'{_OTHER_END}')"
    suspect = f"({column} RLIKE r'{_MORE_AFTER}' OR {end} OR {braces})"
    alone = f"size(from_json(concat('[', {column}, ']'), 'array<string>')) = 1"
    return f"coalesce({suspect} AND NOT coalesce({alone}, false), false)"


def _mistyped(field: str) -> str:
    """A value is present in the text but not in the typed struct."""
    leaf = Leaf.of(variants.member("_doc", f"payload.{field}"))
    return (
        f"(_doc IS NOT NULL AND env.payload.{field} IS NULL AND NOT {variants.is_absent(leaf)})"
    )


def _kind_name(field: str) -> str:
    """The wire contract's name for the JSON type of a member."""
    kind = Leaf.of(variants.member("_doc", f"payload.{field}")).kind
    return f"""CASE WHEN _doc IS NOT NULL THEN CASE WHEN {kind} = 'STRING' THEN 'str'
        WHEN {kind} = 'BOOLEAN' THEN 'bool' WHEN startswith({kind}, 'ARRAY') THEN 'list'
        WHEN startswith({kind}, 'OBJECT') THEN 'dict' END END"""


def _untyped_categories() -> str:
    """Positions of category elements that are present but not JSON strings."""
    elements = variants.elements(Leaf.of(variants.member("_doc", "payload.categories")))
    odd = variants.to_text(Leaf.of("e")).bad
    return f"""coalesce(filter(transform({elements}, (e, i) -> CASE WHEN {odd} THEN i END),
        i -> i IS NOT NULL), cast(array() AS array<int>))"""


def decode(df: DataFrame, column: str = "raw_envelope", schema: str = ENVELOPE) -> DataFrame:
    """Add ``env`` (typed), ``observed_at`` (instant, null if bad) and ``env_check``.

    ``env_check`` says whether the text is a JSON object and which leaves held a
    value of the wrong type, so that mistyped is not reported as missing.
    """
    parse = (
        f"from_json({column}, {quoted(schema + ', _flagged string')}, "
        "map('columnNameOfCorruptRecord', '_flagged'))"
    )
    odd_categories = (
        f"coalesce(array_join(env.payload.categories, '\\n') RLIKE r'{_LITERAL_TEXT}', false)"
    )
    # Null on the fast path: the second parse runs for odd rows only.
    reparse = f"CASE WHEN {_FLAGGED} OR {odd_categories} THEN try_parse_json({column}) END"
    check = f"""named_struct(
        'parsed', coalesce(NOT {_FLAGGED} OR ({column} RLIKE r'^\\s*\\{{'
            AND _doc IS NOT NULL), false) AND NOT {_trailing(column)},
        'rating', {_mistyped('rating')},
        'rating_kind', {_kind_name('rating')},
        'review_count', {_mistyped('review_count')},
        'categories', {_untyped_categories()})"""
    parsed = computed_once(df, "env", parse).selectExpr("*", f"{reparse} AS _doc")
    # The look for trailing text reads the column alone: a filter on the outcome would take it below the first
    # parse, to whatever the column is computed from, and compute that once for every mention.
    checked = computed_once(parsed, "env_check", check)
    return checked.selectExpr("*", f"{to_utc('env.observed_at')} AS observed_at").drop("_doc")


def split_parsed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose envelope is a JSON object, rows whose text is not)."""
    return decoded.filter("env_check.parsed"), decoded.filter("NOT env_check.parsed")


# Rule fields of a frame that went through decode().
DECODED = Record.of_payload(
    "env.payload",
    event_id="env.event_id",
    observed_at="observed_at",
    rating_mistyped="env_check.rating",
    rating_kind="env_check.rating_kind",
    review_count_mistyped="env_check.review_count",
    categories_mistyped="env_check.categories",
)
