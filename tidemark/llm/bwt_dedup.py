"""Removal of repeated byte strings by common prefixes of a Burrows-Wheeler transform.

Equal strings of ``length`` bytes have the same anchor (see ``anchors``), so the strings over repeated
anchors are sent, as the stretches of text that share an anchor, to buckets by that anchor: all
copies of a string meet in one bucket, and a stretch that occurs often counts once a chunk. An anchor that
occurs more than ``HOT`` times anywhere may bring a new stretch each time, so its strings are sent one by
one, by a hash of the whole string, each once a chunk: no key gathers more than ``HOT`` stretches, or one
string a chunk. A bucket
sorts the suffixes of its distinct stretches, those without another of their anchor left out, and derives their longest
common prefixes from the transform, by increasing value: a boundary of value ``v`` between two suffixes, carried one byte
backward wherever both sides have that byte, is a boundary of value ``v + 1``. The search is breadth
first and stops at ``length``; what has no boundary then are intervals of suffixes with that long a
common prefix. In each interval the smallest doc_id keeps its copy.

Strings are compared byte by byte, never by a hash. Matches never cross documents, and copies
within one document stay. Edge cases: a null text is empty; a null doc_id is smaller than all others;
rows of one doc_id do not remove one another; a text shorter than ``length`` stays whole; texts are
taken whole, a very long one is a chunk of its own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm import chunks as ck
from tidemark.llm import text as tx
from tidemark.llm.anchors import Anchors, in_several_chunks_and_hot
from tidemark.session import workspace

LENGTH = 50
_SYMBOLS = 7  # of nine bits, in the first sort key
HOT = 1024  # occurrences of an anchor beyond which its strings are dealt by their own hash
_COMPARED = 1 << 16  # windows compared at a time
PARTS = 32  # of a bucket, by anchor, taken one after the other: a small text is sorted in the cache


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (values below 512) in the order of their first ``depth`` symbols at least.

    After the first sort only suffixes with an equal one are sorted again, by the ranks of what follows: a rank is the
    place of the first suffix that begins alike.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(_SYMBOLS, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(_SYMBOLS):
        key = (key << np.uint64(9)) | padded[i : i + n]
    order, known = np.argsort(key), _SYMBOLS
    if known >= depth or not n:
        return order
    first = np.ones(n + 1, bool)
    first[1:n] = key[order[1:]] != key[order[:-1]]
    bits = np.uint64((n + 1).bit_length())
    ahead = 2 if 3 * int(bits) <= 64 else 1  # ranks that fit beside a suffix's own
    # Beyond the end: less than all ranks.
    rank = np.zeros(n + 1 + depth, np.uint64)
    at = np.flatnonzero(~(first[:-1] & first[1:]))
    rank[order] = np.maximum.accumulate(np.where(first[:-1], np.arange(n, dtype=np.int64), 0)).astype(np.uint64) + np.uint64(1)
    while len(at):
        some = order[at]
        key = rank[some]
        for k in range(1, ahead + 1):
            key = (key << bits) | rank[np.minimum(some + k * known, n)]
        new = np.argsort(key)
        some, key = some[new], key[new]
        order[at] = some
        known *= ahead + 1
        changed = np.ones(len(at) + 1, bool)
        changed[1:-1] = key[1:] != key[:-1]
        if known >= depth:
            break
        rank[some] = np.maximum.accumulate(np.where(changed[:-1], at, 0)).astype(np.uint64) + np.uint64(1)
        at = at[~(changed[:-1] & changed[1:])]
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in ``order`` the common prefix with the place before, as far as ``most``.

    Two suffixes at ``k - 1`` and ``k`` that begin with the same byte are backward extensions, by that byte
    of the transform, of the suffixes at ``low`` and ``high``. Their value is one more than the smallest between
    those, so it is found in the round after the first boundary there was: breadth first, by value. Where ``low``
    and ``high`` are neighbours, as in most places of a repetitive text, there is one boundary to wait for, and the place is
    kept in its list; the others are looked at in every round. No range that is still looked at holds a boundary, so
    places that have one are left out of the count whenever only half of the places are without.
    """
    n = len(text)
    value = np.full(n, most, np.int16)
    if n < 2:
        return np.zeros(n, np.int16)
    place = np.zeros(n + 1, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    place[n] = -1  # the empty suffix comes before all
    symbol, after = text[order], place[order + 1]
    first_same = symbol[:-1] == symbol[1:]
    new = np.concatenate([[0], np.flatnonzero(~first_same) + 1])
    value[new] = 0
    open_ = np.flatnonzero(first_same) + 1
    i, j = after[open_ - 1], after[open_]
    low, high = np.minimum(i, j), np.maximum(i, j)
    single = high - low == 1
    waits = high[single]
    waiting = open_[single][np.argsort(waits)]
    until = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(waits, minlength=n), out=until[1:])
    open_, low, high = open_[~single], low[~single].astype(np.int64) + 1, high[~single].astype(np.int64) + 1
    number, left = np.arange(n, dtype=np.int32), n  # of a place among those that had no boundary at the last look; how many have none
    marked, passed = np.zeros(n + 1, bool), np.zeros(n + 1, np.int32)
    for level in range(1, most):
        begin, count = until[new], until[new + 1] - until[new]
        told = waiting[_ranges(begin, count)]
        if len(open_):
            marked[:] = False
            marked[number[new] + 1] = True
            np.cumsum(marked, dtype=np.int32, out=passed)
            found = passed[high] != passed[low]
            left -= len(new)
            new = np.concatenate([told, open_[found]])
            if found.any():
                some = np.flatnonzero(~found)
                open_, low, high = open_[some], low[some], high[some]
        else:
            new = told
        if not len(new):
            break
        if 2 * left <= len(marked):
            # The boundaries of this round are still to be counted: they get their value below.
            without = value == most
            before = np.zeros(len(marked), np.int32)
            np.cumsum(without[number >= 0], dtype=np.int32, out=before[1:])
            low, high = before[low].astype(np.int64), before[high].astype(np.int64)
            number = np.where(without, np.cumsum(without, dtype=np.int32) - 1, -1).astype(np.int32)
            left = int(before[-1])
            marked, passed = np.zeros(left + 1, bool), np.zeros(left + 1, np.int32)
        value[new] = level
    return value


def removable(strings: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct string, which of its windows of ``length`` occur in one of a smaller doc."""
    sizes = np.array([len(s) for s in strings], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + 1
    text[starts + sizes] = 0  # ends of strings; no byte has this value
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    usable = np.arange(len(text)) + length <= (starts + sizes)[owner]
    order = suffix_array(text, length)
    value = common_prefixes(text, order, length)
    interval = np.cumsum(value < length) - 1
    # Windows that run into an end never count, so an interval's smallest doc is one of usable windows.
    whole = usable[order]
    order, interval = order[whole], interval[whole]
    doc = docs[owner[order]]
    least = np.full(len(text), np.iinfo(np.int64).max)
    np.minimum.at(least, interval, doc)
    gone = np.zeros(len(text), bool)
    gone[order] = doc > least[interval]
    return [gone[a:b] for a, b in zip(starts.tolist(), (starts + sizes - length + 1).tolist(), strict=True)]


class _Stretches:
    """The stretches of a chunk whose windows may be repeated, split where the anchor changes."""

    def __init__(self, chunk: ck.Chunk, length: int):
        self.chunk, self.length = chunk, length
        n, piece = len(chunk.data), max(1, length // 2)
        starts = np.zeros(n + 1, np.int32)
        starts[chunk.off] = 1
        np.cumsum(starts, out=starts)  # equal at both ends of what lies in one text

        def inside(width: int) -> np.ndarray:
            return starts[: max(0, n - width + 1)] == starts[width - 1 : n]

        self.hashes, self.last = tx.sliding_hash(chunk.data, piece, 31), length - piece
        self.anchors = Anchors(self.hashes, inside(piece), inside(length), length - piece + 1)

    def stretches(self, answers: dict[int, bytes], buckets: int):
        """Start, number of windows, key, the number of the first equal stretch of the chunk, and texts of the first.

        The key is the anchor; windows of hot anchors are stretches of their own, with a hash of themselves.
        """
        flags, hot = self.anchors.repeated_and_hot(answers, buckets)
        of = self.anchors.of
        if not flags.any():
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64), none, {}
        hot &= flags
        begins, ends = flags.copy(), flags.copy()
        change = (of[1:] != of[:-1]) | hot[1:] | hot[:-1]
        begins[1:] &= ~flags[:-1] | change
        ends[:-1] &= ~flags[1:] | change
        start = np.flatnonzero(begins)
        count = np.flatnonzero(ends) + 1 - start
        key, same, single = of[start], np.arange(len(start)), np.flatnonzero(hot[start])
        if len(single):
            at = start[single]
            key[single] = tx.mix(tx.mix(self.hashes[at]) ^ self.hashes[at + self.last])
            same[single] = single[self._first_equal(at, key[single])]
        raw, seen = self.chunk.data.tobytes(), {}
        others, stop = np.flatnonzero(~hot[start]), start + count + self.length - 1
        same[others] = [
            seen.setdefault(raw[a:b], i)
            for i, a, b in zip(others.tolist(), start[others].tolist(), stop[others].tolist(), strict=True)
        ]
        texts = {i: text for text, i in seen.items()}
        once = single[same[single] == single]
        texts.update((i, raw[a : a + self.length]) for i, a in zip(once.tolist(), start[once].tolist(), strict=True))
        return start, count, key, same, texts

    def _first_equal(self, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """For each window, the number of the first one with its key, if that has the same bytes, else its own."""
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        found = first[group]
        windows = np.lib.stride_tricks.sliding_window_view(self.chunk.data, self.length)
        for low in range(0, len(at), _COMPARED):
            some = slice(low, low + _COMPARED)
            other = (windows[at[some]] != windows[at[found[some]]]).any(axis=1)
            found[some] = np.where(other, np.arange(len(at))[some], found[some])
        return found


def _anchor_cells(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for chunk in ck.unpacked(batches):
        yield _Stretches(chunk, length).anchors.ask_with_times(chunk.name, buckets)


def _stretch_cells(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for chunk in ck.unpacked(batches):
        start, count, key, same, texts = _Stretches(chunk, length).stretches(chunk.answers[0], buckets)
        first = np.flatnonzero(same == np.arange(len(same)))
        docs, sizes = chunk.order_ids[chunk.doc(start[first])], count[first] + length - 1
        short = (tx.mix(key[first]) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

        def rows(i: np.ndarray) -> tuple:
            steps = np.diff(docs[i], prepend=np.int64(0))
            joined = b"".join([texts[k] for k in first[i].tolist()])
            parts = (short[i].tobytes(), sizes[i].astype(np.uint32).tobytes())
            return squeeze(joined), steps.tobytes(), b"".join(parts)

        bucket = ck.bucket_of(tx.mix(key[first]), buckets)
        yield ck.cells(chunk.name, bucket, buckets, rows)
        # The places themselves come back with the answers, so that they are found once.
        places = np.concatenate([[len(start)], start, count, same, bucket.astype(np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([buckets + zlib.crc32(chunk.name.encode()) % buckets], pa.int32()), pa.array([chunk.name]),
             pa.array([squeeze(np.diff(places, prepend=0).tobytes())], pa.binary()), pa.array([None], pa.binary()),
             pa.array([None], pa.binary())],
            ["bucket", "chunk", "entries", "docs", "extra"],
        )


def _decide(rows: list[dict], length: int) -> list[np.ndarray]:
    """For a bucket of cells: one bit per window of each stretch, whether a smaller doc has it. Places come back as they are.

    Equal windows have the same key, so a text that is the only one of its key shares none with another text.
    """
    if rows[0]["docs"] is None:
        return [np.unpackbits(np.frombuffer(r["entries"], np.uint8)) for r in rows]
    expand = zstandard.ZstdDecompressor().decompress
    numbers: dict[bytes, int] = {}
    number, docs, keys, cuts = [], [], [], [0]
    for r in rows:
        n = len(r["docs"]) // 8
        keys.append(np.frombuffer(r["extra"], np.uint32, n))
        sizes = np.frombuffer(r["extra"], np.uint32, offset=4 * n).astype(np.int64)
        raw = expand(r["entries"], max_output_size=max(1, int(sizes.sum())))
        ends = np.cumsum(sizes)
        number += [
            numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
        ]
        docs.append(np.cumsum(np.frombuffer(r["docs"], np.int64)))
        cuts.append(len(number))
    strings, of, doc = list(numbers), np.array(number, np.int64), np.concatenate(docs)
    least, key = np.full(len(strings), np.iinfo(np.int64).max), np.zeros(len(strings), np.uint32)
    np.minimum.at(least, of, doc)
    key[of] = np.concatenate(keys)
    _, group, times = np.unique(key, return_inverse=True, return_counts=True)
    part = np.where(times[group] > 1, key % PARTS, PARTS)
    none, every = (np.full(max(map(len, strings), default=0), x) for x in (False, True))
    bits = [none[: len(text) - length + 1] for text in strings]
    for p in range(PARTS):
        at = np.flatnonzero(part == p)
        if len(at):
            some = at.tolist()
            for x, gone in zip(some, removable([strings[x] for x in some], least[at], length), strict=True):
                bits[x] = gone
    later = (doc > least[of]).tolist()
    told = [every[: len(bits[x])] if gone else bits[x] for x, gone in zip(number, later, strict=True)]
    return [np.concatenate([np.zeros(0, bool), *told[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    if not len(start):
        return np.zeros(0, np.int64)
    return np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)


def _places(answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows and first equal stretch of each stretch, and the bucket of each first one."""
    (packed,) = [a for bucket, a in answers.items() if bucket >= buckets]
    all_ = np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64))
    n = int(all_[0])
    return all_[1 : n + 1], all_[n + 1 : 2 * n + 1], all_[2 * n + 1 : 3 * n + 1], all_[3 * n + 1 :]


def _results(batches: Iterator[pa.RecordBatch], length: int, buckets: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for chunk in ck.unpacked(batches):
        start, count, same, bucket = _places(chunk.answers[0], buckets)
        n = len(chunk.data)
        gone = np.zeros(n, bool)
        first = np.flatnonzero(same == np.arange(len(same)))
        if len(first):
            bits, at = ck.read_answers(chunk.answers[0], bucket, buckets, count[first])
            gone[_ranges(start[first], count[first])] = bits[_ranges(at, count[first])]
            doc = chunk.order_ids[chunk.doc(start)]
            again = np.flatnonzero(same != np.arange(len(same)))
            later = doc[again] > doc[same[again]]
            gone[_ranges(start[again[later]], count[again[later]])] = True
            equal = again[~later]  # of the same doc: as its first copy
            gone[_ranges(start[equal], count[equal])] = gone[_ranges(start[same[equal]], count[equal])]
        removed = tx.covered(n, np.flatnonzero(gone), length)
        lost = tx.per_text(removed, chunk.off)
        begins = removed.copy()
        edge = np.zeros(n + 1, bool)
        edge[chunk.off] = True
        begins[1:] &= ~removed[:-1] | edge[1:n]
        spans = tx.per_text(begins, chunk.off)
        left = chunk.data[~removed].tobytes()
        sizes = np.diff(chunk.off)
        ends = np.cumsum(sizes - lost)
        kept = [left[a:b] for a, b in zip((ends - (sizes - lost)).tolist(), ends.tolist(), strict=True)]
        columns = [chunk.doc_ids, pa.array(sizes), pa.array(lost), pa.array(spans),
                   pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        if texts:
            columns.append(pa.array(kept, pa.binary()))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
        yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, texts: bool = True, hot: int = HOT) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``texts``, kept_bytes."""
    root = workspace(docs.sparkSession, "bwt")
    chunks = ck.pack(docs, f"{root}/chunks")
    buckets = ck.bucket_count(chunks)
    anchors = ck.ask(
        chunks.mapInArrow(lambda b: _anchor_cells(b, length, buckets), ck.CELL),
        lambda rows: in_several_chunks_and_hot(rows, hot), f"{root}/anchors",
    )
    asked = ck.with_answers(chunks, anchors)
    stretches = ck.ask(
        asked.mapInArrow(lambda b: _stretch_cells(b, length, buckets), ck.CELL),
        lambda rows: _decide(rows, length), f"{root}/stretches",
    )
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return ck.with_answers(chunks, stretches).mapInArrow(
        lambda b: _results(b, length, buckets, texts), schema + ", kept_bytes binary" * texts
    )
