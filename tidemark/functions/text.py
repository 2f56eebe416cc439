"""String predicates and keys."""

from __future__ import annotations

from collections.abc import Sequence


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_blank(x: str) -> str:
    """Null, empty, or nothing but Unicode white space.

    The common case (a first character above the blank) is settled without a
    regular expression.
    """
    return (
        f"({x} IS NULL OR (NOT substring({x}, 1, 1) BETWEEN '!' AND '~' "
        rf"AND NOT {x} RLIKE r'(?U)\S'))"
    )


def key_or_unknown(*candidates: str) -> str:
    """First non-empty candidate, else ``'unknown'``."""
    return f"coalesce({', '.join(f'''nullif({c}, '')''' for c in candidates)}, 'unknown')"


def content_key(parts: Sequence[str]) -> str:
    """SHA-256 over the parts joined by ``§``; a null part counts as ``''``.

    ``concat_ws`` alone would skip nulls and let ``(a, null)`` and ``(null, a)``
    share a key.
    """
    texts = ", ".join(f"coalesce(cast({p} AS string), '')" for p in parts)
    return f"sha2(concat_ws('§', {texts}), 256)"
