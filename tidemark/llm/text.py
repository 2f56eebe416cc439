"""Words, hashes and windows over the text buffer of an Arrow batch, without a Python object per word.

A *slice* is a few megabytes of whole texts: ``data`` holds their UTF-8 bytes one after the
other and text ``i`` is ``data[off[i]:off[i + 1]]``. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BLOCK = 1 << 14  # positions taken at a time where eight bytes or more are held for each
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def sliced(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into slices of about ``limit`` bytes of whole texts."""
    for batch in batches:
        data, off = utf8(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
            yield (
                batch.slice(start, stop - start),
                data[off[start] : off[stop]],
                off[start : stop + 1] - off[start],
            )
            start = stop


def solid(data: np.ndarray) -> np.ndarray:
    """True for bytes that belong to a word."""
    return ~_SPACE[data]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; a word ends where its text does."""
    inside = solid(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(off, starts, "right") - 1


def _pieces(data: np.ndarray, off: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that cut no word: they end at a space or where a text does."""
    start, n = 0, len(data)
    while start < n:
        stop = min(n, start + limit)
        edge = int(off[np.searchsorted(off, stop)])
        while stop < edge:
            spaces = np.flatnonzero(_SPACE[data[stop : min(edge, stop + limit)]])
            if len(spaces):
                edge = stop + int(spaces[0])
            stop = min(edge, stop + limit)
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, off: np.ndarray, seed: int = 0, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and how many words each text has; long texts are taken in pieces."""
    count, hashes = np.zeros(len(off) - 1, np.int64), [np.zeros(0, _U)]
    for a, b in _pieces(data, off, limit):
        first = int(np.searchsorted(off, a, "right")) - 1
        inner = off[first + 1 : int(np.searchsorted(off, b, "left"))]
        starts, ends, owner = words(data[a:b], np.concatenate([[a], inner, [b]]) - a)
        hashes.append(range_hash(prefix_sums(data[a:b], seed), starts, ends))
        found = np.bincount(owner, minlength=len(inner) + 1)
        count[first : first + len(found)] += found
    return np.concatenate(hashes), count


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def scalar_mix(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], _U))[0])


def _table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _BASE + _U(scalar_mix(seed)))


def prefix_sums(data: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial sums, from which ``range_hash`` takes the hash of any byte range."""
    global _powers
    n = len(data) + 1
    if len(_powers[0]) < n:
        up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U))
    sums = np.zeros(n, _U)
    np.cumsum(_table(seed)[data] * _powers[0][: n - 1], dtype=_U, out=sums[1:])
    return sums, _powers[1]


def range_hash(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts:ends]``; equal bytes have equal hashes anywhere."""
    pre, down = sums
    x = (pre[ends] - pre[starts]) * down[starts]
    return mix(x + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def sliding_hash(data: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of all ranges of ``width`` bytes; equal bytes have equal hashes anywhere.

    A hash does not depend on where the sums begin, so they are taken over blocks that stay in the cache.
    """
    if len(data) < width:
        return np.zeros(0, _U)
    found = np.zeros(len(data) - width + 1, _U)
    for a in range(0, len(found), BLOCK):
        block = found[a : a + BLOCK]
        pre, down = prefix_sums(data[a : a + len(block) + width - 1], seed)
        np.subtract(pre[width:], pre[: len(block)], out=block)
        block *= down[: len(block)]
        block[:] = mix(block)
    return found


def join_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two adjacent pieces from the hashes of both."""
    return mix(left * _BASE + (right ^ _U(0xA0761D6478BD642F)))


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive items, by doubling; len(h) - width + 1 values."""
    if len(h) < width:
        return np.zeros(0, _U)
    done, span, power = None, 0, h
    while width:
        if width & 1:
            m = len(power) if done is None else min(len(done), len(power) - span)
            done = power if done is None else join_hash(done[:m], power[span : span + m])
            span += len(h) - len(power) + 1
        width >>= 1
        if width:
            size = len(h) - len(power) + 1
            power = join_hash(power[: len(power) - size], power[size:])
    return done


def windows_inside(group: np.ndarray, width: int) -> np.ndarray:
    """True for windows whose first and last item are of one text."""
    if len(group) < width:
        return np.zeros(0, bool)
    return group[: len(group) - width + 1] == group[width - 1 :]


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """True for the items in one of the windows of ``width`` that begin at ``starts``."""
    ends = np.minimum(starts + width, n)
    depth = np.zeros(n + 1, np.int32)
    depth += np.bincount(starts, minlength=n + 1).astype(np.int32)
    depth -= np.bincount(ends, minlength=n + 1).astype(np.int32)
    return np.cumsum(depth[:n], dtype=np.int32) > 0


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """True where a value is in the sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values
