"""Kinds of VARIANT values and lenient coercion of loosely typed JSON leaves.

Every coercion yields ``(value, bad)``: the converted value or null, and whether
a value was present that cannot be converted. Missing and JSON null are not bad.
"""

from __future__ import annotations

from typing import NamedTuple

_NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
_NUMBER_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"
# The words a boolean field accepts, in any letter case.
_TRUE_WORDS = "'1', 'on', 't', 'true', 'y', 'yes'"
_FALSE_WORDS = "'0', 'off', 'f', 'false', 'n', 'no'"


class Coerced(NamedTuple):
    value: str
    bad: str


class Leaf(NamedTuple):
    """A VARIANT expression and the expression of its kind.

    The kind is ``VOID``, ``STRING``, ``BOOLEAN``, ``BIGINT``, ``OBJECT<..>`` .., and
    SQL null when the value is missing. Where many tests look at one value, compute
    its kind into a column first and name that column here.
    """

    v: str
    kind: str

    @classmethod
    def of(cls, v: str) -> Leaf:
        return cls(v, f"schema_of_variant({v})")


def is_absent(x: Leaf) -> str:
    """Missing or JSON null."""
    return f"coalesce({x.kind} = 'VOID', true)"


def is_number(x: Leaf) -> str:
    return f"({x.kind} RLIKE '{_NUMBER_KINDS}')"


def is_text(x: Leaf) -> str:
    return f"({x.kind} = 'STRING')"


def is_flag(x: Leaf) -> str:
    return f"({x.kind} = 'BOOLEAN')"


def is_array(x: Leaf) -> str:
    return f"startswith({x.kind}, 'ARRAY')"


def is_object(x: Leaf) -> str:
    return f"startswith({x.kind}, 'OBJECT')"


def get(v: str, as_type: str) -> str:
    return f"try_variant_get({v}, '$', '{as_type}')"


def member(v: str, path: str) -> str:
    """A member of a JSON object as VARIANT, null if missing or not an object."""
    return f"try_variant_get({v}, '$.{path}', 'variant')"


def elements(x: Leaf) -> str:
    """The elements of a JSON array as ``array<variant>``, null if it is not one."""
    return f"CASE WHEN {is_array(x)} THEN {get(x.v, 'array<variant>')} END"


def is_empty(x: Leaf) -> str:
    """Absent or an empty value: ``""``, ``0``, ``false``, ``[]``, ``{}``."""
    return f"""({is_absent(x)} OR ({is_flag(x)} AND NOT {get(x.v, 'boolean')})
        OR ({is_number(x)} AND {get(x.v, 'double')} = 0)
        OR coalesce({get(x.v, 'string')}, '?') IN ('', '[]', '{{}}'))"""


def to_text(x: Leaf) -> Coerced:
    """Only JSON strings are text."""
    return Coerced(
        f"CASE WHEN {is_text(x)} THEN {get(x.v, 'string')} END",
        f"(NOT {is_absent(x)} AND NOT {is_text(x)})",
    )


def _number(x: Leaf, pattern: str) -> str:
    text = get(x.v, "string")
    return f"""CASE WHEN {is_number(x)} THEN {get(x.v, 'double')}
        WHEN {is_flag(x)} THEN cast({get(x.v, 'boolean')} AS double)
        WHEN {is_text(x)} AND {text} RLIKE r'{pattern}' THEN try_cast({text} AS double) END"""


def _result(x: Leaf, value: str) -> Coerced:
    return Coerced(value, f"(NOT {is_absent(x)} AND ({value}) IS NULL)")


def to_double(x: Leaf) -> Coerced:
    """Numbers, booleans (1/0) and strings that spell a number."""
    return _result(x, _number(x, _NUMBER_TEXT))


def to_integer(x: Leaf) -> Coerced:
    """Integers, integral floats, booleans and strings of either; 32-bit range."""
    number = f"({_number(x, _INTEGER_TEXT)})"
    return _result(x, f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS int) END")


def to_boolean(x: Leaf) -> Coerced:
    """Booleans, the numbers 0 and 1, and the fixed words."""
    word = f"lower({get(x.v, 'string')})"
    value = f"""CASE WHEN {is_flag(x)} THEN {get(x.v, 'boolean')}
        WHEN {is_number(x)} AND {get(x.v, 'double')} IN (0, 1) THEN {get(x.v, 'double')} = 1
        WHEN {is_text(x)} AND {word} IN ({_TRUE_WORDS}) THEN true
        WHEN {is_text(x)} AND {word} IN ({_FALSE_WORDS}) THEN false END"""
    return _result(x, value)
