"""Least-cost repair of conversations by weighted interval parsing.

A repair is a sequence of edits, one per turn (keep, rerole, delete) and any number of insertions, after which
the role initials read ``(s?(ua)+)?``. The grammar is in Chomsky normal form: nonterminal ``(p, q)`` derives
the edits of a span that lead from state ``p`` to ``q`` of what may come next, by the rules ``(p, q) -> (p, r) (r, q)``
over two adjacent spans and by the edits of a single turn; insertions are closed over on both sides of each turn.
A span's cells hold the least (cost, audit) of each nonterminal. They are combined bottom-up by span length: turns,
then spans of two, four and so on. The states make every way of halving a span give the same cells, so one cut
per span is enough. Audits of one span and equal cost are never prefixes of one another (they have the same edits of turns,
so one more insertion costs more), which is why the least audit of a span consists of least audits of its halves.

Turns are sorted across the cluster by (conversation, turn, role, text), copies of equal rows spread by their row
number. What lies within one partition is parsed there; conversations that partitions cut, or of more than ``BLOCK`` turns,
become blocks: earlier equal turns are found by a grouping over their hashes, each block is parsed alone, blocks are
combined in groups of ``FAN``, level by level, and the repaired text is hashed while its blocks stream by.

Edge cases: a null role or text is one space, in the damage key a null conversation or turn is too; null
turns come first and do not count for gaps; a null conv_id is a conversation; rows of one turn are ordered by role, then
text; an empty role has no legal initial; repeated rows are duplicates. An audit is one string, so a conversation is bounded
by what one value can hold; its texts are not.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import workspace

BLOCK, BLOCK_BYTES = 2048, 1 << 20  # turns of a block, and characters of its texts
FAN = 64  # spans combined at a time
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: What a turn of each initial leads to from each state.
STEPS = {
    "s": {START: AFTER_SYSTEM},
    "u": {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER},
    "a": {AFTER_USER: AFTER_ASSISTANT},
}
LEGAL = {"su", "ua", "au"}
Cells = dict[tuple[int, int], tuple[int, str]]

FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _join(left: Cells, right: Cells) -> Cells:
    """The cells of two adjacent spans as one."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                more, rest = right[r, q]
                if (p, q) not in out or (cost + more, audit + rest) < out[p, q]:
                    out[p, q] = (cost + more, audit + rest)
    return out


def _closure() -> Cells:
    """Insertions only, as few as lead from state to state."""
    one = {(p, q): (INSERT, "I") for i in "ua" for p, q in STEPS[i].items()}
    none: Cells = {(p, p): (0, "") for p in range(4)}
    out = none
    for _ in range(3):
        longer = _join(out, one)
        out = {k: min(c for c in (out.get(k), longer.get(k), none.get(k)) if c) for k in {*out, *longer}}
    return out


EMPTY = _closure()


def _leaf(kind: str) -> Cells:
    """Cells of one turn: ``x`` must go; else its initial, ``o`` for any other, in upper case if it is unfinished."""
    cells: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "x":
        extra = UNFINISHED if kind.isupper() else 0
        edits = [(step, REROLE, "R") for i in "ua" for step in STEPS[i].items()]
        edits += [(step, KEEP, "K") for step in STEPS.get(kind.lower(), {}).items()]
        for step, cost, letter in edits:
            cells[step] = min(cells.get(step, (1 << 30, "")), (cost + extra, letter))
    return _join(_join(EMPTY, cells), EMPTY)


_LEAVES = {kind: _leaf(kind) for kind in "xsuaoSUAO"}


def parse(kinds: str) -> Cells:
    """The cells of a span of turns, by spans of doubled length."""
    if len(kinds) <= 32:
        return _parse_short(kinds)
    return _bottom_up([_parse_short(kinds[i : i + 32]) for i in range(0, len(kinds), 32)])


def _bottom_up(spans: list[Cells]) -> Cells:
    while len(spans) > 1:
        paired = [_join(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = paired + spans[len(paired) * 2 :]
    return spans[0] if spans else EMPTY


@lru_cache(maxsize=1 << 14)
def _parse_short(kinds: str) -> Cells:
    return _bottom_up([_LEAVES[k] for k in kinds])


def best(cells: Cells) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation: nothing, or ending after an assistant."""
    return min(cells[START, START], cells[START, AFTER_ASSISTANT])


def rendered(audit: str, turns: list[tuple[str, str]], state: int = START) -> tuple[list[str], int]:
    """The ``role:text`` lines of a repaired span, and the state behind it."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = ("", "") if edit == "I" else turns[at]
        at += edit != "I"
        if edit == "K":
            state = STEPS[role[0]][state]
        else:
            role = "assistant" if state == AFTER_USER else "user"
            state = STEPS[role[0]][state]
        out.append(f"{role}:{text}")
    return out, state


@dataclass(frozen=True)
class Span:
    """Counts and cells of adjacent turns of a conversation."""

    n: int
    first: str  # initials of the first and last turn
    last: str
    low: int | None  # turn numbers
    high: int | None
    numbers: int  # how many different ones
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cells: Cells

    def __add__(self, other: Span) -> Span:
        if not other.n or not self.n:
            return self if self.n else other
        joint = self.high is not None and self.high == other.low
        return Span(
            self.n + other.n, self.first, other.last,
            other.low if self.low is None else self.low, self.high if other.high is None else other.high,
            self.numbers + other.numbers - joint, self.blank + other.blank, self.duplicate + other.duplicate,
            self.truncated + other.truncated, self.illegal + other.illegal + (self.last + other.first not in LEGAL),
            _join(self.cells, other.cells),
        )

    def result(self) -> dict:
        cost, audit = best(self.cells)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": cost, "audit": audit}

    def dump(self) -> str:
        return json.dumps([asdict(replace(self, cells={})), [[*k, *v] for k, v in self.cells.items()]])

    @staticmethod
    def load(text: str) -> Span:
        fields, cells = json.loads(text)
        return Span(**{**fields, "cells": {(p, q): (c, a) for p, q, c, a in cells}})


NOTHING = Span(0, "", "", None, None, 0, 0, 0, 0, 0, EMPTY)


def span(turns: list[int | None], roles: list[str], texts: list[str], repeated: list[bool]) -> Span:
    """Faults and cells of turns in order; ``repeated`` tells which were there before."""
    if not turns:
        return NOTHING
    kinds, found = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text, again in zip(roles, texts, repeated, strict=True):
        end = text.rstrip(SPACE)[-1:]
        fault = "blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else None
        if fault:
            found[fault] += 1
        initial = role[:1] if role[:1] in STEPS else "o"
        kinds.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
    known = [t for t in turns if t is not None]
    illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
    return Span(len(turns), roles[0][:1], roles[-1][:1], known[0] if known else None, known[-1] if known else None,
                len(set(known)), **found, illegal=illegal, cells=parse("".join(kinds)))


# -- Spark ------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage; a dropped row stays as a null role and text."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    hit = F.col("hit")
    return (
        conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                             (F.crc32(F.encode(key, "utf-8")) % 20).alias("hit"))
        .withColumn("copy", F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id", "turn",
            F.when(hit == 0, F.lit(None)).when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(hit == 0, F.lit(None)).when(hit == 1, "").when(hit == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")).alias("text"),
        )
    )


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_TURNS = "part int, block int, turns array<bigint>, roles array<string>, texts array<string>"


class _Pieces:
    """Rows of the output of a pass over sorted turns: results of whole conversations, blocks of the others."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.rows, self.size = kind, [], 0

    def add(self, size: int, **row) -> None:
        self.rows.append(row)
        self.size += size

    def batch(self) -> pa.RecordBatch:
        names = ["conv_id", "whole", *FIGURES, "audit", "repaired_sha256", "part", "block", "turns", "roles", "texts"]
        kinds = [self.kind, pa.bool_(), *[pa.int64()] * len(FIGURES), pa.string(), pa.string(), pa.int32(), pa.int32(),
                 pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
        columns = [pa.array([r.get(n) for r in self.rows], k) for n, k in zip(names, kinds, strict=True)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(columns, names)


def _whole(conv, turns: list, roles: list, texts: list) -> dict:
    seen: set[tuple[str, str]] = set()
    repeated = []
    for pair in zip(roles, texts, strict=True):
        repeated.append(pair in seen)
        seen.add(pair)
    out = span(turns, roles, texts, repeated).result()
    lines, _ = rendered(out["audit"], list(zip(roles, texts, strict=True)))
    digest = hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()
    return {"conv_id": conv, "whole": True, **out, "repaired_sha256": digest}


def _sorted_turns(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Conversations that surely lie within the partition are done here; the others are cut into blocks."""
    part, block, out = TaskContext.get().partitionId(), 0, None
    conv, opened, first, cut, size = None, False, True, False, 0
    held: tuple[list, list, list] = ([], [], [])

    def put_block() -> None:
        nonlocal block, size, held
        out.add(size, conv_id=conv, whole=False, part=part, block=block, turns=held[0], roles=held[1], texts=held[2])
        block, size, held = block + 1, 0, ([], [], [])

    for batch in batches:
        out = out or _Pieces(batch.schema.field(0).type)
        for c, turn, role, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            if not opened or c != conv:
                if opened:
                    if first or cut:
                        put_block()
                    else:
                        out.add(100, **_whole(conv, *held))
                        held, size = ([], [], []), 0
                    first, cut = False, False
                conv, opened = c, True
            if role is not None:
                if held[0] and (len(held[0]) >= most or size + len(text) > BLOCK_BYTES):
                    put_block()
                    cut = True
                for column, value in zip(held, (turn, role, text), strict=True):
                    column.append(value)
                size += len(role) + len(text)
            if out.size >= 4 * BLOCK_BYTES or len(out.rows) >= 4096:
                yield out.batch()
    if opened:
        put_block()
        yield out.batch()


def _block_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for turns, roles, texts, firsts in zip(*(batch.column(i).to_pylist() for i in range(3, 7)), strict=True):
            known = set(firsts or ())
            spans.append(span(turns, roles, texts, [i not in known for i in range(len(turns))]).dump())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, pa.string())],
                                         ["conv_id", "part", "block", "span"])


def _combined(table: pa.Table, fan: int) -> pa.Table:
    """A group of adjacent spans as one, bottom-up."""
    table = table.sort_by("place")
    spans = [Span.load(s) for s in table.column("span").to_pylist()]
    while len(spans) > 1:
        paired = [a + b for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = paired + spans[len(paired) * 2 :]
    place = pa.array([table.column("place")[0].as_py() // fan])
    return pa.table({"conv_id": table.column("conv_id")[:1], "place": place, "span": pa.array([spans[0].dump()], pa.string())})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation behind the row with its audit: the digest of the repaired text."""
    names = ["conv_id", *FIGURES, "audit", "repaired_sha256"]
    head, digest, state, at, lines = None, None, START, 0, 0

    def put(edits: str, turns: list) -> None:
        nonlocal state, lines
        got, state = rendered(edits, turns, state)
        if got:
            digest.update((("\n" if lines else "") + "\n".join(got)).encode("utf-8"))
            lines += len(got)

    def done() -> list:
        put(head["audit"][at:], [])
        return [*[head[n] for n in names[:-1]], digest.hexdigest()]

    for batch in batches:
        rows, kind = [], batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if row["part"] < 0:
                if head is not None:
                    rows.append(done())
                head, digest, state, at, lines = row, hashlib.sha256(), START, 0, 0
                continue
            end, left = at, len(row["roles"])
            while left:
                left -= head["audit"][end] != "I"
                end += 1
            put(head["audit"][at:end], list(zip(row["roles"], row["texts"], strict=True)))
            at = end
        yield _results(rows, names, kind)
    if head is not None:
        yield _results([done()], names, kind)


def _results(rows: list, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * len(FIGURES), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
    )


def _kind(df: DataFrame) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}"


def _across_partitions(blocks: DataFrame, root: str, fan: int) -> DataFrame:
    """Results of conversations that are several blocks, or may be."""
    spark, kind = blocks.sparkSession, _kind(blocks)
    # The first place of each role and text: no other turn of them is new.
    places = blocks.select("conv_id", "part", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "said"))
    firsts = (
        places.groupBy("conv_id", "said.roles", F.sha2("said.texts", 256))
        .agg(F.min(F.struct("part", "block", "i")).alias("first"))
        .groupBy("first.part", "first.block").agg(F.collect_list("first.i").alias("firsts"))
    )
    blocks.select("conv_id", "part", "block", "turns", "roles", "texts").join(firsts, ["part", "block"], "left").select(
        "conv_id", "part", "block", "turns", "roles", "texts", "firsts"
    ).mapInArrow(_block_spans, f"{kind}, part int, block int, span string").write.parquet(f"{root}/spans0")
    order = Window.partitionBy("conv_id").orderBy("part", "block")
    spans = spark.read.parquet(f"{root}/spans0").select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "span"
    )
    level = 0
    while True:
        level += 1
        spans.groupBy("conv_id", F.floor(F.col("place") / fan)).applyInArrow(
            lambda t: _combined(t, fan), f"{kind}, place bigint, span string"
        ).write.parquet(f"{root}/spans{level}")
        spans = spark.read.parquet(f"{root}/spans{level}")
        if not (spans.agg(F.max("place")).first()[0] or 0):
            break

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Span.load(s).result() for s in batch.column(1).to_pylist()]
            columns = [pa.array([r[n] for r in found], pa.int64()) for n in FIGURES]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array([r["audit"] for r in found], pa.string())],
                ["conv_id", *FIGURES, "audit"],
            )

    heads = spans.select("conv_id", "span").mapInArrow(totals, f"{kind}, {_RESULT}").select("*", F.lit(-1).alias("part"))
    rows = heads.unionByName(blocks.select("conv_id", "part", "block", "roles", "texts"), allowMissingColumns=True)
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
        .mapInArrow(_hashed, f"{kind}, {_RESULT}, repaired_sha256 string")
    )


def repair(damaged: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text`` rows: counts of faults, cost, audit, repaired_sha256.

    A row of a null role tells that the conversation exists and is no turn.
    """
    spark, kind = damaged.sparkSession, _kind(damaged)
    root = workspace(spark, "conversations")
    order = ["conv_id", "turn", "role", "text"]
    # Equal rows are spread by their number, so that a row repeated without end is no task of its own.
    dealt = damaged.select(*order, F.monotonically_increasing_id().alias("row")).repartitionByRange(*order, "row")
    dealt.sortWithinPartitions(*order).select(*order).mapInArrow(
        lambda b: _sorted_turns(b, block), f"{kind}, whole boolean, {_RESULT}, repaired_sha256 string, {_TURNS}"
    ).write.parquet(f"{root}/pieces")
    pieces = spark.read.parquet(f"{root}/pieces")
    columns = ["conv_id", *FIGURES, "audit", "repaired_sha256"]
    whole = pieces.filter("whole").select(*columns)
    return whole.unionByName(_across_partitions(pieces.filter("NOT whole"), root, fan).select(*columns))
