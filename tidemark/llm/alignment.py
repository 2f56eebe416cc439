"""Alignment of two tokenizers' tokens, and how often their ids go together.

Both tokenizations of a text are increasing lists of byte offsets at which tokens end. They are merged along
the merge path: diagonals of the grid of the two lists, ``PIECE`` steps apart, are searched in a binary search for where the
merge crosses them, which divides the merge into pieces of equal work that need nothing of one another. A piece emits the
offsets at which both end; a pair of equal ends that a diagonal would part stays with the piece in front of it. The number of
cuts in the pieces before stitches what is open at a piece's end to what follows. Between two cuts lies a group, and its tokens
of both sides overlap: they are linked.

A chunk of a few megabytes of texts is one row: its distinct id pairs, in how many of its documents each is, and each document's
pairs as places among them. Pair counts are summed over the chunks. The summed table is bounded by the two vocabularies; it is cut
by the first id into ``BUCKETS``, so each id's highest count is known within a bucket. Chunks then ask for the
counts of their pairs, ``ASKED`` chunks and one bucket a task, and sum them per document.

Edge cases: a null or empty text, or one whose joined tokens are not the text's bytes behind a space, has no tokens:
zeros and an empty digest; special tokens written in a text are plain text; rows of one doc_id are separate
documents; a null doc_id stays null. A large group's links are counted by id, not listed.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.bpe import printable_bytes
from tidemark.session import workspace

PIECE = 1 << 16  # steps of the merge in a piece
CHUNK_BYTES = 4 << 20
BUCKETS = 64  # of the table of pairs, by first id
ASKED = 1024  # chunks that ask a bucket together
LISTED = 4096  # links of a group that are listed; those of larger ones are counted by id
TEXTS = 1 << 20  # characters aligned at a time; longer texts are cut
WORDS = 200_000  # of the second tokenizer, kept in a worker
_LONG = 1000  # characters of a word beyond which the slower library takes a text


def _ints(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class ByteTokens:
    """The first tokenizer: a byte-level vocabulary file of the tokenizers library.

    Its ranks also serve the tiktoken library, which gives the same ids several times faster. That takes texts of
    Latin-1 characters without very long words, on which the two libraries' pre-tokens are the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte, special = printable_bytes(), {t["content"] for t in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        self.bytes: list[bytes] = [b""] * (max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for word, i in ids.items():
            if word not in special:
                self.bytes[i] = bytes(to_byte[c] for c in word)
        self.sizes = np.array([*map(len, self.bytes)], np.int64)
        self.fast = self._fast(spec, ids, special)

    def _fast(self, spec: dict, ids: dict, special: set):
        """The tiktoken form, where merges come in the order of their ids; else none."""
        import tiktoken

        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [ids[a + b] for a, b in pairs]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if merged != sorted(set(merged)) or spec["normalizer"] or any(
            spec["pre_tokenizer"].get(k, v) != v for k, v in plain.items()
        ):
            return None
        ranks = {self.bytes[i]: i for w, i in ids.items() if w not in special}
        # Fixed value: the pattern that byte-level vocabularies of this kind are split by.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @staticmethod
    def _plain(text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        words = text.split()
        lengths = [*map(len, words)]
        return max(lengths, default=0) < _LONG and len(text) - sum(lengths) < len(words) + _LONG

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids of each text behind a space, as 32-bit integers, and whether they spell it; bytes always do."""
        texts = [" " + t for t in texts]
        out = [(_ints(self.fast(t)), True) if self.fast and self._plain(t) else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, found in zip(rest, self.slow.encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = _ints(found.ids), b"".join([self.bytes[k] for k in found.ids]) == texts[i].encode("utf-8")
        return out


class PieceTokens:
    """The second tokenizer: a sentencepiece model, which puts a space in front of a text.

    Where no piece has a space behind another character, words are encoded on their own and the newest are kept.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        shown = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in enumerate(shown)
        ]
        self.sizes = np.array([*map(len, self.bytes)], np.int64)
        self.apart = not any("▁" in p.lstrip("▁") for p in shown)
        self.known: dict[str, tuple[bytes, bool]] = {}
        self.before: dict[str, tuple[bytes, bool]] = {}

    def _whole(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        return [
            (_ints(ids), b"".join([self.bytes[k] for k in ids]) == b" " + t.encode("utf-8"))
            for t, ids in zip(texts, self.model.encode(texts, num_threads=1) if texts else [], strict=True)
        ]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids of each text, as 32-bit integers, and whether they spell it behind a space."""
        split = [
            t.split(" ") if self.apart and t and t[0] != " " and t[-1] != " " and "  " not in t else None for t in texts
        ]
        needed = {w for words in split if words for w in words}
        if len(self.known) + len(needed) > WORDS:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        needed = [w for w in needed if w not in known]
        known.update((w, before[w]) for w in needed if w in before)
        fresh = [w for w in needed if w not in before]
        known.update(zip(fresh, self._whole(fresh), strict=True))
        rest = iter(self._whole([t for t, words in zip(texts, split, strict=True) if words is None]))
        out = []
        for words in split:
            if words is None:
                out.append(next(rest))
            else:
                found = [known[w] for w in words]
                out.append((b"".join([f[0] for f in found]), all([f[1] for f in found])))
        return out


@lru_cache(maxsize=4)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@lru_cache(maxsize=4)
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def merge_path(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How much of ``a`` and of ``b`` (both increasing) lies before each piece of the merge, ``a`` first of equals.

    Both ends of an equal pair go to one piece.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        i = (low + high) // 2
        open_ = low < high
        # Too little of a, if its next element is not behind the last one taken of b.
        before = np.where(open_, b[np.clip(diagonal - i - 1, 0, max(0, len(b) - 1))] if len(b) else 0, 0)
        more = open_ & (a[np.minimum(i, max(0, len(a) - 1))] <= before if len(a) else False)
        low, high = np.where(more, i + 1, low), np.where(open_ & ~more, i, high)
    i, j = low, diagonal - low
    if len(a) and len(b):
        parted = (i > 0) & (j < len(b)) & (a[np.maximum(i, 1) - 1] == b[np.minimum(j, len(b) - 1)])
        j = j + parted
    return i, j


def groups(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of each token of both sides, and the offsets that close the groups; both lists have the same last end."""
    i, j = merge_path(a, b, step)
    ga, gb, cuts, done = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), [np.zeros(0, a.dtype)], 0
    for k in range(len(i) - 1):
        mine, theirs = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        closed = np.intersect1d(mine, theirs, assume_unique=True)
        # What is behind the last cut is open: it has the number that the next piece begins with.
        ga[i[k] : i[k + 1]] = done + np.searchsorted(closed, mine)
        gb[j[k] : j[k + 1]] = done + np.searchsorted(closed, theirs)
        cuts.append(closed)
        done += len(closed)
    return ga, gb, np.concatenate(cuts)


def _links(ids: tuple, of: tuple, doc_of_group: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id pair and number of the links; equal pairs may come several times."""
    (a, b), (ga, gb) = ids, of
    n = len(doc_of_group)
    x, y = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    a_start, b_start = np.cumsum(x) - x, np.cumsum(y) - y
    large = x * y > LISTED
    times = np.where(large, 0, y)[ga]
    left = np.repeat(np.arange(len(a)), times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(b_start[ga], times)
    docs, codes = [doc_of_group[ga[left]]], [a[left] * stride + b[right]]
    numbers = [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(large):
        (u, m), (v, k) = (
            np.unique(s[t[g] : t[g] + c[g]], return_counts=True) for s, t, c in ((a, a_start, x), (b, b_start, y))
        )
        codes.append(np.add.outer(u * stride, v).ravel())
        numbers.append(np.multiply.outer(m, k).ravel())
        docs.append(np.full(len(codes[-1]), doc_of_group[g]))
    return np.concatenate(docs), np.concatenate(codes), np.concatenate(numbers)


def _spelled(ids: tuple, of: tuple, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Text of all groups, ``a,a|b;a|b,b``, and where each group ends in it, its own separator included."""
    (a, b), (ga, gb) = ids, of
    x, y = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    size = int(max(a.max(initial=0), b.max(initial=0))) + 1
    a_end, b_end = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_end[np.cumsum(x) - 1] = True
    b_end[np.cumsum(y) - 1] = True
    order = np.zeros(len(a) + len(b), np.int32)
    order[np.arange(len(a)) + (np.cumsum(y) - y)[ga]] = a + size * a_end
    order[np.arange(len(b)) + np.cumsum(x)[gb]] = b + 2 * size * b_end
    used, place = np.unique(order, return_inverse=True)
    shown = pa.array([f"{c % size}{',|;'[c // size]}" for c in used.tolist()], pa.large_string())
    spelled = shown.take(pa.array(place))
    _, offsets, values = spelled.buffers()
    ends = np.frombuffer(offsets, np.int64)[np.cumsum(x + y)]
    return np.frombuffer(values, np.uint8), ends


def _packed(x: np.ndarray) -> bytes:
    """Integers of nearby values, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(x, prepend=x.dtype.type(0)).tobytes())


def _unpacked(raw: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype), dtype=dtype)


CHUNK = (
    "chunk string, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, digests array<string>, pairs binary, holders binary, n_pairs array<bigint>, "
    "places binary, numbers binary"
)


_CUT = re.compile(r"(?<=\S) (?=\S)")


def _pieces(texts: list[str], limit: int) -> Iterator[tuple[int, str]]:
    """Texts, long ones cut at single spaces: number of the text, and what is between two cuts.

    No token of either side goes across such a space from the front, so pieces have the tokens of the whole.
    """
    for i, text in enumerate(texts):
        at = 0
        while limit and len(text) - at > limit and (cut := _CUT.search(text, at + limit)):
            yield i, text[at : cut.start()]
            at = cut.end()
        if text:
            yield i, text[at:]


def _distinct_pairs(doc: np.ndarray, code: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry for each document and pair, in that order."""
    order = np.lexsort((code, doc))
    doc, code, number = doc[order], code[order], number[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    begin = np.flatnonzero(new)
    return doc[begin], code[begin], np.add.reduceat(number, begin) if len(begin) else number


def _some_aligned(numbers: list[int], texts: list[str], tokens: tuple, out: dict, bad: set[int], step: int) -> tuple:
    """Adds up counts and digests of some pieces, and returns their links."""
    found = [t.encode(texts) for t in tokens]
    bad.update(i for side in found for i, (_, good) in zip(numbers, side, strict=True) if not good)
    good = [k for k in range(len(texts)) if found[0][k][1] and found[1][k][1]]
    of = np.array([numbers[k] for k in good], np.int64)
    ids, ends = [], []
    for name, side, t in zip(("n_a", "n_b"), found, tokens, strict=True):
        np.add.at(out[name], of, [len(side[k][0]) // 4 for k in good])
        ids.append(np.frombuffer(b"".join([side[k][0] for k in good]), np.int32).astype(np.int64))
        ends.append(np.cumsum(t.sizes[ids[-1]]))
    ga, gb, cuts = groups(*ends, step)
    end = np.cumsum([len(texts[k].encode("utf-8")) + 1 for k in good], dtype=np.int64)
    piece = np.searchsorted(end, cuts, "left")
    counted = np.bincount(piece, minlength=len(good))
    np.add.at(out["n_groups"], of, counted)
    if len(cuts):
        values, at = _spelled(tuple(ids), (ga, gb), len(cuts))
        start = 0
        for i, g in zip(of.tolist(), (np.cumsum(counted) - 1).tolist(), strict=True):
            digest = out["digests"][i]
            if digest is None:
                digest = out["digests"][i] = hashlib.sha256()
            else:
                digest.update(b";")
            digest.update(values[start : at[g] - 1])
            start = int(at[g])
    return _distinct_pairs(*_links(tuple(ids), (ga, gb), of[piece], len(tokens[1].bytes)))


def aligned(texts: list[str], first: ByteTokens, second: PieceTokens, limit: int = TEXTS, step: int = PIECE) -> dict:
    """Tokens, groups and links of some texts, about ``limit`` characters at a time."""
    n = len(texts)
    out: dict = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"digests": [None] * n}
    none = np.zeros(0, np.int64)
    links, bad, held, size = [(none, none, none)], set(), [], 0
    for piece in _pieces(texts, limit if second.apart else 0):
        held.append(piece)
        size += len(piece[1])
        if size >= limit:
            links.append(_some_aligned(*map(list, zip(*held, strict=True)), (first, second), out, bad, step))
            held, size = [], 0
    if held:
        links.append(_some_aligned(*map(list, zip(*held, strict=True)), (first, second), out, bad, step))
    doc, code, number = _distinct_pairs(*(np.concatenate(c) for c in zip(*links, strict=True)))
    if bad:
        wrong = np.zeros(n, bool)
        wrong[list(bad)] = True
        doc, code, number = doc[~wrong[doc]], code[~wrong[doc]], number[~wrong[doc]]
        for c in ("n_a", "n_b", "n_groups"):
            out[c][wrong] = 0
    out["digests"] = ["" if i in bad or d is None else d.hexdigest() for i, d in enumerate(out["digests"])]
    np.add.at(out["n_links"], doc, number)
    pairs, places, holders = np.unique(code, return_inverse=True, return_counts=True)
    return out | {
        "pairs": pairs, "holders": holders, "n_pairs": np.bincount(doc, minlength=n),
        "places": places.astype(np.int32), "numbers": number,
    }


def _chunks(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], size: int) -> Iterator[pa.RecordBatch]:
    first, second = byte_tokens(paths[0]), piece_tokens(paths[1])
    names = [c.split()[0] for c in CHUNK.split(", ")]
    number, task = 0, TaskContext.get().partitionId()
    for batch, _, _ in tx.sliced(batches, limit=size):
        found = aligned([t or "" for t in batch.column(1).to_pylist()], first, second)
        row = {"chunk": f"{task}-{number}", "doc_ids": batch.column(0).to_pylist(), **found}
        for name in ("pairs", "holders", "places", "numbers"):
            row[name] = _packed(row[name])
        number += 1
        kinds = [pa.string(), pa.list_(pa.int64()), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), pa.binary(),
                 pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds, strict=True)], names)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, holders in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(_unpacked(pairs, np.int64)), pa.array(_unpacked(holders, np.int64))], ["pair", "n"]
            )


def _bucket(table: pa.Table, stride: int) -> pa.Table:
    """All pairs of a bucket's first ids with their counts, and whether it is the highest of the first id."""
    table = table.sort_by("pair")
    pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    first = pair // stride
    begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    most = np.repeat(np.maximum.reduceat(n, begin), np.diff(np.append(begin, len(n))))
    return pa.table({
        "bucket": table.column("bucket")[:1], "pairs": pa.array([_packed(pair)], pa.binary()),
        "counts": pa.array([_packed(n)], pa.binary()), "best": pa.array([np.packbits(n == most).tobytes()], pa.binary()),
    })


def _questions(batches: Iterator[pa.RecordBatch], stride: int, salts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = _unpacked(raw, np.int64)
            bucket = pairs // stride % BUCKETS
            full = np.unique(bucket)
            salt = zlib.crc32(chunk.encode()) % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([salt] * len(full), pa.int32()), pa.array([chunk] * len(full), pa.string()),
                 pa.array([_packed(pairs[bucket == k]) for k in full], pa.binary())],
                ["bucket", "salt", "chunk", "pairs"],
            )


def _answered(asked: pa.Table, table: pa.Table) -> pa.Table:
    pairs, counts = (_unpacked(table.column(c)[0].as_py(), np.int64) for c in ("pairs", "counts"))
    best = np.unpackbits(np.frombuffer(table.column("best")[0].as_py(), np.uint8), count=len(pairs))
    n, top = [], []
    for raw in asked.column("pairs").to_pylist():
        at = np.searchsorted(pairs, _unpacked(raw, np.int64))
        n.append(_packed(counts[at]))
        top.append(np.packbits(best[at]).tobytes())
    return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"),
                     "counts": pa.array(n, pa.binary()), "best": pa.array(top, pa.binary())})


def _results(batches: Iterator[pa.RecordBatch], stride: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        for row in batch.to_pylist():
            pairs = _unpacked(row["pairs"], np.int64)
            bucket = pairs // stride % BUCKETS
            counts, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            for answer in row["answers"] or []:
                at = np.flatnonzero(bucket == answer["bucket"])
                counts[at] = _unpacked(answer["counts"], np.int64)
                best[at] = np.unpackbits(np.frombuffer(answer["best"], np.uint8), count=len(at))
            places, numbers = _unpacked(row["places"], np.int32), _unpacked(row["numbers"], np.int64)
            ends = np.cumsum(row["n_pairs"], dtype=np.int64)
            sums = []
            for value in (best[places] * numbers, counts[places] * numbers):
                total = np.concatenate([[0], np.cumsum(value)])
                sums.append(total[ends] - total[ends - np.array(row["n_pairs"], np.int64)])
            columns = [row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], *sums]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns], pa.array(row["digests"], pa.string())], names
            )


def align(docs: DataFrame, first: str, second: str, chunk_bytes: int = CHUNK_BYTES, asked: int = ASKED) -> DataFrame:
    """One row per row of ``doc_id, text``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``first`` is a byte-level vocabulary file, ``second`` a sentencepiece model.
    """
    spark = docs.sparkSession
    root = workspace(spark, "alignment")
    stride = len(piece_tokens(second).bytes)
    paths = (first, second)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda b: _chunks(b, paths, chunk_bytes), CHUNK
    ).write.parquet(f"{root}/chunks")
    chunks = spark.read.parquet(f"{root}/chunks")
    summed = chunks.select("pairs", "holders").mapInArrow(_counts, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    summed.withColumn("bucket", F.expr(f"cast(pair div {stride} % {BUCKETS} AS int)")).groupBy("bucket").applyInArrow(
        lambda t: _bucket(t, stride), "bucket int, pairs binary, counts binary, best binary"
    ).write.parquet(f"{root}/table")
    salts = -(-chunks.count() // asked) or 1
    table = spark.read.parquet(f"{root}/table").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    questions = chunks.select("chunk", "pairs").mapInArrow(
        lambda b: _questions(b, stride, salts), "bucket int, salt int, chunk string, pairs binary"
    )
    # Every salt of a bucket that nobody asks has nothing to answer.
    questions.groupBy("bucket", "salt").cogroup(table.groupBy("bucket", "salt")).applyInArrow(
        _answered, "chunk string, bucket int, counts binary, best binary"
    ).write.parquet(f"{root}/answers")
    answers = spark.read.parquet(f"{root}/answers").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "counts", "best")).alias("answers")
    )
    schema = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
              "count_sum bigint, groups_sha256 string")
    return chunks.join(answers, "chunk", "left").mapInArrow(lambda b: _results(b, stride), schema)
