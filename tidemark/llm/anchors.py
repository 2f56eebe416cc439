"""Anchors of windows: the smallest hash of the pieces in a window, the same wherever it occurs.

A window that occurs twice has a piece that occurs twice: its anchor. So it is enough to ask, for the
anchors alone (about two in ``span`` positions), which of them occur more than once; windows of
other anchors are unique. Nothing repeated is missed.
"""

from __future__ import annotations

import numpy as np
import zstandard

from tidemark.llm import chunks as ck
from tidemark.llm import text as tx

_MOST = np.iinfo(np.uint64).max


def _slid(x: np.ndarray, span: int, pick) -> np.ndarray:
    """The pick (minimum or maximum) of each ``span`` adjacent values."""
    done, width = x, 1
    while width * 2 <= span:
        done = pick(done[: len(done) - width], done[width:])
        width *= 2
    rest = span - width
    return pick(done[: len(done) - rest], done[rest:]) if rest else done


class Anchors:
    """Anchors of the windows of ``span`` pieces; ``inside`` tells which windows lie in one text."""

    def __init__(self, pieces: np.ndarray, usable: np.ndarray, inside: np.ndarray, span: int):
        self.inside = inside
        if not len(inside):
            self.of = self.values = np.zeros(0, np.uint64)
            self.several = np.zeros(0, bool)
            self.times = np.zeros(0, np.int64)
            return
        n, self.of, found = len(inside), np.zeros(len(inside), np.uint64), []
        pad = np.zeros(span - 1, np.uint64)
        # In blocks that stay in the cache.
        for a in range(0, n, tx.BLOCK):
            some = slice(a, min(a + tx.BLOCK, n) + span - 1)
            self.of[a : a + tx.BLOCK] = _slid(np.where(usable[some], pieces[some], _MOST), span, np.minimum)
        for a in range(0, n + span - 1, tx.BLOCK):
            some = slice(a, min(a + tx.BLOCK, n + span - 1))
            # The windows that a piece of the block is in: they begin up to span - 1 places in front of it.
            low, high = a - span + 1, some.stop
            shown = np.where(inside[max(low, 0) : high], self.of[max(low, 0) : high], np.uint64(0))
            shown = np.concatenate([pad[: max(-low, 0)], shown, pad[: max(high - n, 0)]])
            # A piece is an anchor if it is the smallest of some window it is in.
            here = pieces[some]
            found.append(here[(here == _slid(shown, span, np.maximum)) & usable[some]])
        self.values, self.times = np.unique(np.concatenate(found), return_counts=True)
        # Of two or more pieces in this chunk: repeated, whatever the other chunks hold.
        self.several = self.times > 1

    def ask(self, chunk: str, buckets: int):
        """The chunk's cells: its distinct anchors, by 32 bits beside those of the bucket."""
        keys = tx.mix(self.values)
        short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return ck.cells(chunk, ck.bucket_of(keys, buckets), buckets, lambda at: (short[at].tobytes(), None, None))

    def ask_with_times(self, chunk: str, buckets: int):
        """As ``ask``, with the number of times each anchor occurs in the chunk."""
        keys, squeeze = tx.mix(self.values), zstandard.ZstdCompressor(level=1).compress
        short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        times = self.times.astype(np.uint32)
        return ck.cells(chunk, ck.bucket_of(keys, buckets), buckets,
                        lambda at: (short[at].tobytes(), None, squeeze(times[at].tobytes())))

    def repeated(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """True for the windows whose anchor occurs more than once anywhere."""
        if not len(self.values):
            return np.zeros(len(self.inside), bool)
        bits, start = ck.read_answers(answers, ck.bucket_of(tx.mix(self.values), buckets), buckets)
        return self._windows(bits[start] | self.several)

    def repeated_and_hot(self, answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``repeated``, of answers to ``ask_with_times``; and the windows whose anchor is hot."""
        if not len(self.values):
            return np.zeros(len(self.inside), bool), np.zeros(len(self.inside), bool)
        two = np.full(len(self.values), 2, np.int64)
        bits, start = ck.read_answers(answers, ck.bucket_of(tx.mix(self.values), buckets), buckets, two)
        hot = bits[start + 1]
        # Both at a time, so that the anchors are looked up once: one bit each.
        flags = self._windows((bits[start] | self.several) + hot * np.uint8(2))
        return (flags & 1).astype(bool), flags > 1

    def _windows(self, known: np.ndarray) -> np.ndarray:
        """What is known of the anchors, for each window."""
        change = np.flatnonzero(np.concatenate([[True], self.of[1:] != self.of[:-1]]))
        at = np.minimum(np.searchsorted(self.values, self.of[change]), len(self.values) - 1)
        flags = known[at] * (self.values[at] == self.of[change])
        return np.repeat(flags, np.diff(np.append(change, len(self.of)))) * self.inside


def in_several_chunks(rows: list[dict]) -> list[np.ndarray]:
    """For a bucket of cells of distinct hashes: which of them another cell has too."""
    parts = [np.frombuffer(r["entries"], np.uint32) for r in rows]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    twice = np.zeros(len(values), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.split(twice, np.cumsum([len(p) for p in parts])[:-1])




def in_several_chunks_and_hot(rows: list[dict], bound: int) -> list[np.ndarray]:
    """As ``in_several_chunks``, and which occur more than ``bound`` times in all: two bits for each hash."""
    expand = zstandard.ZstdDecompressor().decompress
    sizes = [len(r["entries"]) // 4 for r in rows]
    values = np.concatenate([np.frombuffer(r["entries"], np.uint32) for r in rows])
    times = np.concatenate([
        np.frombuffer(expand(r["extra"], max_output_size=max(1, 4 * n)), np.uint32)
        for r, n in zip(rows, sizes, strict=True)
    ])
    order = np.argsort(values, kind="stable")
    begins = np.concatenate([[True], values[order[1:]] != values[order[:-1]]])
    group = np.cumsum(begins) - 1
    several = np.bincount(group) > 1
    hot = np.add.reduceat(times[order].astype(np.int64), np.flatnonzero(begins)) > bound
    bits = np.zeros((len(values), 2), bool)
    bits[order, 0], bits[order, 1] = several[group], hot[group]
    return [x.reshape(-1) for x in np.split(bits, np.cumsum(sizes)[:-1])]
