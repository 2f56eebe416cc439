"""Byte-level BPE as dynamic programming over prefixes.

Each prefix of a pre-token has exactly one valid last token. All vocabulary entries that end at a
position come from one pass of a suffix automaton over the bytes; a match ``t`` that starts at ``j`` is the
last token of its prefix if it is compatible with the last token of prefix ``j``: undoing both
tokens' merges from the latest to the earliest, no merge across the seam would have come first.
The ids follow from the last prefix back along the stored tokens. No merge loop runs over the text.

The new pre-tokens of some hundred texts are taken together, position by position: the automaton's states, the
matches still to be tried and the pair tests are arrays over all of them. Pre-tokens of more than ``SHORT`` bytes go
one by one. Ids of pre-tokens are kept per worker in two generations of ``CACHE`` entries: where the
newer is full it becomes the older one. What is kept changes the speed only.

Edge cases: a null text is encoded as the empty text (no ids); special tokens written in a text
become their id, as the vocabulary file asks; repeated rows are encoded row by row.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 300_000  # pre-tokens of a generation
SHORT = 48  # bytes of a pre-token up to which many are encoded at once
#: Fixed value: the pattern that byte-level vocabularies of this kind are split by.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers newer than Unicode 16, which the tokenizers library does not know as such.
_NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7"
    "\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1"
    "\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    "\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    "\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)
_PLAIN = regex.compile(_PATTERN).findall
_HAS_NEWER = regex.compile(f"[{_NEWER}]").search
#: The same pattern with the newer characters taken out of its classes.
_CAREFUL = regex.compile(
    _PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_NEWER}])")
    .replace(r" ?\p{L}+", rf" ?(?:(?![{_NEWER}])\p{{L}})+")
    .replace(r" ?\p{N}+", rf" ?(?:(?![{_NEWER}])\p{{N}})+")
).findall


def split(text: str) -> list[str]:
    """The pre-tokens of a text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        if _HAS_NEWER(text):
            return _CAREFUL(text)
    return _PLAIN(text)


def printable_bytes() -> dict[str, int]:
    """Vocabulary files write each byte as a printable character: itself, or one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary file in the JSON form of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"] or {}
        model = spec["model"]
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only byte-level vocabularies without normalizer and prefix space are read")
        to_byte = printable_bytes()
        ids = model["vocab"]
        self.bytes = {i: bytes(to_byte[c] for c in word) for word, i in ids.items()}
        self.left, self.right, self.rank = {}, {}, {i: -1 for i in ids.values()}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = ids[a + b]
            self.merge[ids[a], ids[b]] = rank
            self.left[whole], self.right[whole], self.rank[whole] = ids[a], ids[b], rank
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that strip or match whole words are not read")
        for word, i in self.specials.items():
            self.bytes[i] = word.encode()
        longest = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.automaton = ahocorasick.Automaton()
        self.plain = {i for i in ids.values() if self._whole(i)}
        for i in ids.values():
            if i in self.plain:
                text = self.bytes[i].decode("latin-1")
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.batch = _Batch(self)

    def is_plain(self, token: int) -> bool:
        """Whether text may encode to the token: its bytes do, and it is no special one."""
        return token in self.plain

    def _whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        if self.rank[token] < 0:
            return True
        a, b = self.left[token], self.right[token]
        return self._whole(a) and self._whole(b) and self.compatible(a, b, self.rank[token])

    def compatible(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether ``a`` followed by ``b`` stays so: no merge over the seam comes before theirs."""
        rank = self.rank
        while True:
            seam = self.merge.get((a, b))
            if seam is not None and seam < limit:
                return False
            at, bt = rank[a], rank[b]
            if at < 0 and bt < 0:
                return True
            if at > bt:
                limit, a = at, self.right[a]
            else:  # of equal merges the left one comes first, so the seam wins a tie with b's
                limit, b = bt + 1, self.left[b]

    def last_tokens(self, piece: bytes) -> list[tuple[int, int]]:
        """(last token, its length) of each prefix of the piece, from length 1 on."""
        last: list[tuple[int, int] | None] = [None] * (len(piece) + 1)
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            stop, begin = end + 1, end + 1 - match[1]
            if last[stop] is None and (
                begin == 0 or (before := last[begin]) is not None and self.compatible(before[0], match[0])
            ):
                last[stop] = match
        return last[1:]

    def encode_piece(self, piece: bytes) -> list[int]:
        last, at, out = self.last_tokens(piece), len(piece), []
        while at:
            token, size = last[at - 1]
            out.append(token)
            at -= size
        return out[::-1]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def _special_parts(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special tokens: what is in a part, and whether it is one."""
        if not self.special or not self.special.search(text):
            return [(text, False)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        return [*out, (text[at:], False)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        parts = [[(array("i", [self.specials[x]]).tobytes() if special else split(x)) for x, special in self._special_parts(t)]
                 for t in texts]
        needed: set[str] = set()
        for text in parts:
            needed.update(*[p for p in text if isinstance(p, list)])
        runs = self._runs_of(needed)
        return [
            b"".join([p if isinstance(p, bytes) else b"".join([runs[x] for x in p]) for p in text]) for text in parts
        ]

    def _runs_of(self, needed: set[str]) -> dict[str, bytes]:
        """The ids of pre-tokens, those of ``needed`` at least."""
        if len(self.runs) + len(needed) > CACHE:
            self.runs, self.older = {}, self.runs
        missing = needed - self.runs.keys()
        known = missing & self.older.keys()
        self.runs.update({x: self.older[x] for x in known})
        missing -= known
        short, long_ = [], []
        for x in missing:
            raw = x.encode()
            (short if len(raw) <= SHORT else long_).append((x, raw))
        found = dict(zip([x for x, _ in short], self.batch.encode([raw for _, raw in short]), strict=True))
        self.runs.update(found)
        if not long_:
            return self.runs
        return self.runs | {x: array("i", self.encode_piece(raw)).tobytes() for x, raw in long_}

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed([text or ""])[0]).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class _Batch:
    """The same for many short pre-tokens at once, in arrays."""

    _NONE = np.int32(-1)

    def __init__(self, codec: Codec):
        n = max(codec.bytes) + 1
        self.left, self.right, self.rank, self.size = (np.full(n, -1, np.int32) for _ in range(4))
        for i, raw in codec.bytes.items():
            self.size[i] = len(raw)
        for i in codec.left:
            self.left[i], self.right[i], self.rank[i] = codec.left[i], codec.right[i], codec.rank[i]
        pairs = np.array(list(codec.merge), np.int64).reshape(-1, 2)
        self.width = n
        self.merges = _Table(pairs[:, 0] * n + pairs[:, 1], np.array(list(codec.merge.values()), np.int32))
        self._automaton([(i, raw) for i, raw in codec.bytes.items() if codec.is_plain(i)])

    def _automaton(self, tokens: list[tuple[int, bytes]]) -> None:
        """States are beginnings of tokens. ``fail``: the longest proper end of a state that is one too; ``ends``: the
        token that a state is; ``shorter``: the next token along the fails."""
        steps, ends, depth, parent = {}, [-1], [0], [(0, 0)]
        for i, raw in tokens:
            state = 0
            for byte in raw:
                key = state << 8 | byte
                state = steps.get(key, 0)
                if not state:
                    state = steps[key] = len(ends)
                    ends.append(-1)
                    depth.append(depth[key >> 8] + 1)
                    parent.append((key >> 8, byte))
            ends[state] = i
        self.steps = _Table(np.fromiter(steps, np.int64, len(steps)), np.fromiter(steps.values(), np.int32, len(steps)))
        self.ends, self.depth = np.array(ends, np.int32), np.array(depth, np.int32)
        self.fail, self.shorter = (np.zeros(len(ends), np.int32) for _ in range(2))
        above = np.array(parent, np.int64)
        for level in range(2, int(self.depth.max(initial=0)) + 1):
            at = np.flatnonzero(self.depth == level)
            self.fail[at] = self._next(self.fail[above[at, 0]], above[at, 1])
        for level in range(1, int(self.depth.max(initial=0)) + 1):
            at = np.flatnonzero(self.depth == level)
            to = self.fail[at]
            self.shorter[at] = np.where(self.ends[to] >= 0, to, self.shorter[to])

    def _next(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after one more byte."""
        out, state = np.zeros(len(state), np.int32), state.copy()
        open_ = np.arange(len(state))
        while len(open_):
            found = self.steps.get(state[open_].astype(np.int64) << 8 | byte[open_])
            out[open_] = np.maximum(found, 0)
            open_ = open_[(found < 0) & (state[open_] > 0)]
            state[open_] = self.fail[state[open_]]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Codec.compatible`` of many pairs."""
        out = np.ones(len(a), bool)
        at, limit = np.arange(len(a)), np.full(len(a), np.iinfo(np.int32).max, np.int32)
        while len(at):
            seam = self.merges.get(a.astype(np.int64) * self.width + b)
            bad = (seam >= 0) & (seam < limit)
            out[at[bad]] = False
            left, right = self.rank[a], self.rank[b]
            on = ~bad & ((left >= 0) | (right >= 0))
            at, a, b, left, right = at[on], a[on], b[on], left[on], right[on]
            first = left > right
            # Of equal merges the left one comes first, so the seam wins a tie with b's.
            limit = np.where(first, left, right + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit integers."""
        if not pieces:
            return []
        size = np.array([*map(len, pieces)])
        order = np.argsort(-size, kind="stable")
        size, n, most = size[order], len(pieces), int(size.max())
        text = np.zeros((most, n), np.uint8)
        flat = np.frombuffer(b"".join([pieces[i] for i in order]), np.uint8)
        column = np.repeat(np.arange(n), size)
        text[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), column] = flat
        last = np.full((most + 1, n), self._NONE)
        state = np.zeros(n, np.int32)
        for end in range(1, most + 1):
            m = int(np.searchsorted(-size, -end, "right"))  # the longest come first
            state = self._next(state[:m], text[end - 1, :m].astype(np.int64))
            match = np.where(self.ends[state] >= 0, state, self.shorter[state])
            open_ = np.flatnonzero(match)
            while len(open_):
                now = match[open_]
                token, begin = self.ends[now], end - self.depth[now]
                before = last[begin, open_]
                good = begin == 0
                some = np.flatnonzero(before >= 0)
                good[some] = self.compatible(before[some], token[some])
                last[end, open_[good]] = token[good]
                open_, now = open_[~good], now[~good]
                match[open_] = self.shorter[now]
                open_ = open_[match[open_] > 0]
        return self._back(last, size, order)

    def _back(self, last: np.ndarray, size: np.ndarray, order: np.ndarray) -> list[bytes]:
        """Follow the stored tokens from the end of each piece."""
        at, row = size.copy(), np.arange(len(size))
        found = []
        while len(row):
            token = last[at[row], row]
            found.append((row, token))
            at[row] -= self.size[token]
            row = row[at[row] > 0]
        count = np.zeros(len(size), np.int64)
        for row, _ in found:
            count[row] += 1
        ends = np.cumsum(count)
        ids = np.zeros(int(ends[-1]), np.int32)
        for step, (row, token) in enumerate(found):
            ids[ends[row] - 1 - step] = token
        raw, out = ids.tobytes(), [b""] * len(size)
        for i, a, b in zip(order.tolist(), (4 * (ends - count)).tolist(), (4 * ends).tolist(), strict=True):
            out[i] = raw[a:b]
        return out


class _Table:
    """Integers by integer keys of 0 or more, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] < 0
            # Of several that want a free slot one gets it.
            self.keys[slot[left[free]]] = keys[left[free]]
            got = self.keys[slot[left]] == keys[left]
            self.values[slot[left[got]]] = values[left[got]]
            left = left[~got]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 if there is none."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        at = np.flatnonzero((there >= 0) & (there != keys))
        while len(at):
            slot[at] = (slot[at] + 1) & self.mask
            there = self.keys[slot[at]]
            hit = there == keys[at]
            out[at[hit]] = self.values[slot[at[hit]]]
            at = at[(there >= 0) & ~hit]
        return out


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path)


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        size = max(1, min(512, batch.num_rows))
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield part.column(0), [x or "" for x in part.column(1).to_pylist()]


def _two(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and ids (array of int) of each row's whole ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for doc_id, texts in _by_text(batches):
            packed = c.packed(texts)
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(np.diff(ends), pa.int64()), ids], ["doc_id", "n_tokens", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _two(docs).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the text of ``ids``; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            texts = [c.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _parts(values: pa.Array, count: np.ndarray) -> Iterator[memoryview]:
    """The bytes of ``count`` values each, one after the other."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(count)])].tolist()
    raw = memoryview(data if data is not None else b"")
    return (raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 without moving the ids out of the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        known = range(max(c.bytes) + 1)
        shown = pa.array([f"{i}," for i in known], pa.large_string())
        spelled = pa.array([c.bytes.get(i, b"") for i in known], pa.large_binary())
        for doc_id, texts in _by_text(batches):
            packed = c.packed(texts)
            count = np.array([len(p) // 4 for p in packed])
            ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
            decimals, back = (_parts(table.take(ids), count) for table in (shown, spelled))
            # The decimals end with a comma that is none of the list's.
            digests = [hashlib.sha256(d[:-1]).hexdigest() for d in decimals]
            decoded = [hashlib.sha256(bytes(x).decode("utf-8", "replace").encode()).hexdigest() for x in back]
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(count, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _two(docs).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
