"""Removal of repeated word windows, found by one step from half their length to the whole.

Level 1 looks at half windows: those that anchor the windows of a text (see ``anchors``) are asked for
among all chunks. Only windows over a half that is repeated are extended to the full length and
asked for again, now with their place; there are no further levels, at any length. Words covered by a full window that also starts
earlier (in a smaller doc_id, or earlier in the same document) are removed, judged on the input.

Full windows are compared by 96 bits of hash, halves by 64. Edge cases: a null text has no words; a
null doc_id orders before all others; rows of one doc_id are ordered by a hash of their text, and equal rows stand in any
order, which changes no result; a text shorter
than a window keeps all its words; the texts are taken whole, a very long one is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import chunks as ck
from tidemark.llm import text as tx
from tidemark.llm.anchors import Anchors, in_several_chunks
from tidemark.session import workspace

WINDOW = 20
_SALT = np.uint64(0x2545F4914F6CDD1D)


class _Windows:
    """The windows of a chunk, and which of them may be repeated."""

    def __init__(self, chunk: ck.Chunk, window: int):
        self.chunk, self.window = chunk, window
        self.starts, ends, self.owner = tx.words(chunk.data, chunk.off)
        self.words = tx.range_hash(tx.prefix_sums(chunk.data, 23), self.starts, ends)
        half = max(1, window // 2)
        halves = tx.window_hash(self.words, half)
        self.inside = tx.windows_inside(self.owner, window)
        self.anchors = Anchors(halves, tx.windows_inside(self.owner, half), self.inside, window - half + 1)

    def candidates(self, answers: dict[int, bytes], buckets: int):
        """Start and hash of each full window over a repeated half, and which is the chunk's first of its kind."""
        at = np.flatnonzero(self.anchors.repeated(answers, buckets))
        full = tx.window_hash(self.words, self.window)[at] if len(at) else np.zeros(0, np.uint64)
        first = np.zeros(len(at), bool)
        first[np.unique(full, return_index=True)[1]] = True
        return at, full, first

    def second(self, at: np.ndarray) -> np.ndarray:
        """32 further bits of the hash of each window."""
        if not len(at):
            return np.zeros(0, np.uint32)
        return (tx.window_hash(tx.mix(self.words ^ _SALT), self.window)[at] >> np.uint64(32)).astype(np.uint32)


def _halves(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for chunk in ck.unpacked(batches):
        yield _Windows(chunk, window).anchors.ask(chunk.name, buckets)


def _fulls(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for chunk in ck.unpacked(batches):
        w = _Windows(chunk, window)
        at, full, first = w.candidates(chunk.answers[0], buckets)
        at, full = at[first], full[first]
        more, docs, keys = w.second(at), chunk.order_ids[w.owner[at]], chunk.text_keys[w.owner[at]]

        def rows(i: np.ndarray) -> tuple:
            # doc_ids as differences: mostly zeros, which the shuffle's compression takes away.
            steps = np.diff(docs[i], prepend=np.int64(0)).tobytes() + np.diff(keys[i], prepend=np.uint64(0)).tobytes()
            return full[i].tobytes(), steps, more[i].tobytes()

        yield ck.cells(chunk.name, ck.bucket_of(full, buckets), buckets, rows)


def _not_first(rows: list[dict]) -> list[np.ndarray]:
    """For a bucket of cells of distinct windows: which of them start earlier in another cell."""
    keys = [np.frombuffer(r["entries"], np.uint64) for r in rows]
    full = np.concatenate(keys)
    more = np.concatenate([np.frombuffer(r["extra"], np.uint32) for r in rows])
    docs = np.concatenate([np.cumsum(np.frombuffer(r["docs"], np.int64, len(k))) for r, k in zip(rows, keys, strict=True)])
    texts = np.concatenate([
        np.cumsum(np.frombuffer(r["docs"], np.uint64, offset=8 * len(k)), dtype=np.uint64) for r, k in zip(rows, keys, strict=True)
    ])
    rank = np.argsort(np.argsort([r["chunk"] for r in rows]))
    place = np.repeat(rank, [len(k) for k in keys])
    order = np.lexsort((place, texts, docs, more, full))
    same = (full[order[1:]] == full[order[:-1]]) & (more[order[1:]] == more[order[:-1]])
    later = np.zeros(len(full), bool)
    later[order[1:][same]] = True
    return np.split(later, np.cumsum([len(k) for k in keys])[:-1])


def _results(batches: Iterator[pa.RecordBatch], window: int, buckets: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for chunk in ck.unpacked(batches):
        w = _Windows(chunk, window)
        at, full, first = w.candidates(chunk.answers[0], buckets)
        gone = ~first
        if first.any():
            bits, start = ck.read_answers(chunk.answers[1], ck.bucket_of(full[first], buckets), buckets)
            gone[first] = bits[start]
        removed = tx.covered(len(w.starts), at[gone], window)
        n = len(chunk.off) - 1
        count = np.bincount(w.owner, minlength=n)
        lost = np.bincount(w.owner[removed], minlength=n)
        first_word = np.concatenate([[0], np.cumsum(count)])
        raw, kept = chunk.data.tobytes(), []
        for i in range(n):
            words = raw[chunk.off[i] : chunk.off[i + 1]].split()
            if lost[i]:
                words = compress(words, (~removed[first_word[i] : first_word[i + 1]]).tolist())
            kept.append(b" ".join(words))
        columns = [chunk.doc_ids, pa.array(count.astype(np.int64)), pa.array(lost.astype(np.int64)),
                   pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        if texts:
            columns.append(pa.array([k.decode() for k in kept], pa.string()))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept_text."""
    root = workspace(docs.sparkSession, "windows")
    chunks = ck.pack(docs, f"{root}/chunks")
    buckets = ck.bucket_count(chunks)
    halves = ck.ask(chunks.mapInArrow(lambda b: _halves(b, window, buckets), ck.CELL), in_several_chunks, f"{root}/halves")
    asked = ck.with_answers(chunks, halves)
    fulls = ck.ask(asked.mapInArrow(lambda b: _fulls(b, window, buckets), ck.CELL), _not_first, f"{root}/fulls")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts
    return ck.with_answers(chunks, halves, fulls).mapInArrow(lambda b: _results(b, window, buckets, texts), schema)
