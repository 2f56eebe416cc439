"""Raw listing bodies to the normalised payload, failures set aside.

A listing whose members all have their proper JSON types, which is nearly every
one, is parsed once into a typed struct. Those that may not (a parser flag, a
member that should be text but does not start with a quote) are parsed again as
VARIANT and coerced leaf by leaf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions import variants
from tidemark.functions.barrier import computed_once
from tidemark.functions.text import quoted
from tidemark.functions.variants import Coerced, Leaf
from tidemark.schemas import LISTING, PAYLOAD

_NO_TEXTS = "cast(array() AS array<string>)"
_TEXTS = ("url", "image_url", "price", "phone")
_COORDINATES = ("latitude", "longitude")
_LOCATION = ("address1", "city", "state", "country", "zip_code")

# Text that a typed parse could turn into a string although it is not one: a text
# member with a bare value (a null is fine except for the name), a list of other
# than plain strings, or a null list element.
_OTHER_TEXT = "|".join(("id", "alias", *_TEXTS, *_LOCATION))
_SUSPECT = (
    rf'"(?:(?:{_OTHER_TEXT})"\s*:\s*(?!"|null)'
    r'|name"\s*:\s*(?!")'
    r'|transactions"\s*:\s*(?!null|\[\s*\]|\[\s*"[^"\\]*"(?:\s*,\s*"[^"\\]*")*\s*\]))'
    r"|[\[,]\s*null"
)
# An escaped letter may hide a member's name from the pattern.
_ESCAPED = "\\\\u00"

# Leaves of the careful path by payload path; each becomes a column of its kind.
_LEAVES = {
    "business_id": "id",
    "name": "name",
    **{t: t for t in _TEXTS},
    "is_closed": "is_closed",
    "rating": "rating",
    "review_count": "review_count",
    "categories": "categories",
    "coordinates": "coordinates",
    "location": "location",
    "transactions": "transactions",
    **{f: f"coordinates.{f}" for f in _COORDINATES},
    **{f: f"location.{f}" for f in _LOCATION},
}


def category_aliases(categories: Leaf) -> Coerced:
    """Non-empty ``alias`` of each category object, in order.

    Bad if the value is not an array of objects, or an alias is not a string.
    """
    alias, element = Leaf.of("a"), Leaf.of("c")
    items = variants.elements(categories)
    named = (
        f"filter(transform({items}, c -> {variants.member('c', 'alias')}), "
        f"a -> NOT {variants.is_empty(alias)})"
    )
    odd = (
        f"(exists({items}, c -> NOT {variants.is_object(element)}) "
        f"OR exists({named}, a -> NOT {variants.is_text(alias)}))"
    )
    return _list_of(categories, f"transform({named}, a -> {variants.get('a', 'string')})", odd)


def text_list(x: Leaf) -> Coerced:
    """An array of JSON strings."""
    items = variants.elements(x)
    odd = f"exists({items}, t -> NOT coalesce({variants.is_text(Leaf.of('t'))}, false))"
    return _list_of(x, f"transform({items}, t -> {variants.get('t', 'string')})", odd)


def _list_of(x: Leaf, value: str, odd: str) -> Coerced:
    """Empty values give an empty list; anything that is not an array is bad."""
    empty = variants.is_empty(x)
    return Coerced(
        f"CASE WHEN {empty} THEN {_NO_TEXTS} ELSE coalesce({value}, {_NO_TEXTS}) END",
        f"(NOT {empty} AND coalesce({odd}, true))",
    )


def _not_an_object(x: Leaf) -> str:
    return f"(NOT {variants.is_empty(x)} AND NOT coalesce({variants.is_object(x)}, false))"


def _struct(**fields: str) -> str:
    return f"named_struct({', '.join(f'{quoted(k)}, {v}' for k, v in fields.items())})"


def _payload(value: dict[str, str]) -> str:
    return _struct(
        business_id=value["business_id"],
        name=f"coalesce({value['name']}, '')",
        url=value["url"],
        image_url=value["image_url"],
        is_closed=value["is_closed"],
        rating=value["rating"],
        review_count=value["review_count"],
        price=value["price"],
        phone=value["phone"],
        categories=value["categories"],
        coordinates=_struct(**{f: value[f] for f in _COORDINATES}),
        location=_struct(**{f: value[f] for f in _LOCATION}),
        transactions=value["transactions"],
        search_term="search_term",
        search_location="search_location",
    )


def _typed_outcome() -> str:
    """Outcome of a listing that needs no coercion."""
    value = {name: f"_typed.{path}" for name, path in _LEAVES.items()}
    value["categories"] = (
        "coalesce(filter(_typed.categories.alias, a -> a <> ''), " + _NO_TEXTS + ")"
    )
    value["transactions"] = f"coalesce(_typed.transactions, {_NO_TEXTS})"
    return _struct(payload=f"cast({_payload(value)} AS {PAYLOAD})", failed="_typed.id IS NULL")


def _careful_outcome() -> str:
    """Outcome of a listing that is coerced leaf by leaf."""
    leaf = {name: Leaf(f"_leaf.{name}", f"_kind.{name}") for name in _LEAVES}
    coerced = {
        **{n: variants.to_text(leaf[n]) for n in ("business_id", "name", *_TEXTS, *_LOCATION)},
        **{n: variants.to_double(leaf[n]) for n in ("rating", *_COORDINATES)},
        "is_closed": variants.to_boolean(leaf["is_closed"]),
        "review_count": variants.to_integer(leaf["review_count"]),
        "categories": category_aliases(leaf["categories"]),
        "transactions": text_list(leaf["transactions"]),
    }
    rejects = [
        # Not JSON, or no id.
        variants.is_absent(leaf["business_id"]),
        # A missing name is empty text; a JSON null is not a name.
        f"coalesce({leaf['name'].kind} = 'VOID', false)",
        _not_an_object(leaf["coordinates"]),
        _not_an_object(leaf["location"]),
        *(c.bad for c in coerced.values()),
    ]
    payload = _payload({n: c.value for n, c in coerced.items()})
    return _struct(
        payload=f"cast({payload} AS {PAYLOAD})", failed=f"coalesce({' OR '.join(rejects)}, true)"
    )


def normalize(listings: DataFrame, listing: str = "listing") -> DataFrame:
    """Add ``payload`` and ``normalize_failed`` to raw listings. Narrow.

    Needs ``search_term`` and ``search_location``. Unknown members are dropped, null
    nested objects become empty ones, loosely typed leaves are coerced. A listing
    that cannot be coerced is flagged; its ``payload`` is then not meaningful.
    """
    parse = (
        f"from_json({listing}, {quoted(LISTING + ', _flagged string')}, "
        "map('columnNameOfCorruptRecord', '_flagged'))"
    )
    suspect = f"""coalesce(_typed IS NULL OR _typed._flagged IS NOT NULL
        OR contains({listing}, '{_ESCAPED}') OR {listing} RLIKE r'{_SUSPECT}', true)"""
    leaves = _struct(**{n: variants.member("_doc", path) for n, path in _LEAVES.items()})
    kinds = _struct(**{n: f"schema_of_variant(_leaf.{n})" for n in _LEAVES})
    staged = (
        computed_once(listings, "_typed", parse)
        .selectExpr("*", f"CASE WHEN {suspect} THEN try_parse_json({listing}) END AS _doc",
                    f"{suspect} AS _suspect")
        .selectExpr("*", f"CASE WHEN _suspect THEN {leaves} END AS _leaf")
        .selectExpr("*", f"CASE WHEN _suspect THEN {kinds} END AS _kind")
    )
    outcome = f"CASE WHEN _suspect THEN {_careful_outcome()} ELSE {_typed_outcome()} END"
    return (
        computed_once(staged, "_outcome", outcome)
        .selectExpr("*", "_outcome.payload AS payload", "_outcome.failed AS normalize_failed")
        .drop("_typed", "_doc", "_suspect", "_leaf", "_kind", "_outcome")
    )


def split_normalized(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listings with a usable payload, listings that could not be normalised)."""
    return normalized.filter("NOT normalize_failed"), normalized.filter("normalize_failed")
