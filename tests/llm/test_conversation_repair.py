"""Conversation repair against a search over all edit sequences."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversation_repair as cr

LEGAL = re.compile(r"(s?(ua)+)?")


def _cheapest(kinds: list[tuple[str, bool, bool]], exhaustive: bool = False) -> tuple[int, str, str]:
    """(cost, audit, initials) by trying edit sequences in the order of their cost, then audit.

    ``kinds``: initial, must be deleted, unfinished. Unless ``exhaustive``, only the first way to each
    place and last initial goes on.
    """
    queue, known = [(0, "", "", 0)], set()
    while queue:
        cost, audit, said, at = heapq.heappop(queue)
        if not exhaustive and (at, said[-1:]) in known:
            continue
        known.add((at, said[-1:]))
        if at == len(kinds) and LEGAL.fullmatch(said):
            return cost, audit, said
        steps = [(3, "I", x, at) for x in "ua"]
        if at < len(kinds):
            initial, bad, open_end = kinds[at]
            steps.append((4, "D", "", at + 1))
            if not bad:
                steps += [(3 + 3 * open_end, "R", x, at + 1) for x in "ua"]
                steps.append((3 * open_end, "K", initial, at + 1))
        for more, letter, x, then in steps:
            text = said + x
            # A beginning that no legal text has is left out.
            if re.fullmatch(r"s?(ua)*u?", text):
                heapq.heappush(queue, (cost + more, audit + letter, text, then))
    raise AssertionError


def _expected(rows):
    """conv_id -> the contract's figures, by the definitions."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = {}
    for conv, turns in kept.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, kinds, seen = [], [], set()
        for _, role, text in turns:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            kinds.append((role[:1] or "?", fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit, said = _cheapest(kinds)
        at, lines, names = iter(turns), [], iter(said)
        for edit in audit:
            if edit == "D":
                next(at)
                continue
            initial = next(names)
            role = {"u": "user", "a": "assistant"}.get(initial)
            _, own, text = (None, role, "") if edit == "I" else next(at)
            lines.append(f"{own if edit == 'K' else role}:{text}")
        numbers = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def _got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in (*cr.FIGURES, "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def _conversations(seed: int, n: int, most: int):
    rng = random.Random(seed)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "open end", " ", "", None, "Why? ", "été.\n", "a.b"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            number = rng.choice([turn, turn, turn, turn + 3, None, 1])
            rows.append((conv if conv % 17 else None, number, rng.choice(roles), rng.choice([*texts, f"turn {turn}."])))
    return rows


@pytest.mark.parametrize("kinds", ["", "x", "u", "a", "s", "ua", "sua", "au", "uu", "ss", "UA", "oua", "uxa", "usaua"])
def test_cells(kinds):
    asked = [(k.lower() if k != "x" else "u", k == "x", k.isupper()) for k in kinds]
    assert cr.best(cr.parse(kinds)) == _cheapest(asked)[:2]


def test_every_short_conversation():
    for kinds in itertools.product("xsuaoUA", repeat=4):
        asked = [(k.lower() if k != "x" else "u", k == "x", k.isupper()) for k in kinds]
        assert cr.best(cr.parse("".join(kinds))) == _cheapest(asked)[:2], kinds
    for kinds in itertools.product("xsuaUA", repeat=3):
        asked = [(k.lower() if k != "x" else "u", k == "x", k.isupper()) for k in kinds]
        assert _cheapest(asked) == _cheapest(asked, exhaustive=True), kinds


def test_cuts_give_the_same_cells():
    rng = random.Random(4)
    for _ in range(200):
        kinds = "".join(rng.choices("xsuaoSUAO", k=rng.randint(1, 80)))
        at = rng.randint(0, len(kinds))
        assert cr._join(cr.parse(kinds[:at]), cr.parse(kinds[at:])) == cr.parse(kinds)


def test_conversations(spark):
    rows = _conversations(1, 120, 7)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, part int, row string")
    want = _expected(rows)
    got = _got(cr.repair(cr.damage(df.repartition(5))))
    assert got == want


def test_cut_conversations(spark):
    """One conversation holds most rows, so partitions, blocks and levels cut it."""
    rng = random.Random(9)
    rows = _conversations(2, 20, 4)
    rows += [(500, t, rng.choice(["user", "assistant"]), rng.choice([f"say {t % 11}.", f"say {t}.", "open"])) for t in range(60)]
    rows += [(501, 1, "user", "the same.")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged = cr.damage(df.repartition(3))
    assert _got(cr.repair(damaged, block=3, fan=2)) == _got(cr.repair(damaged)) == _expected(rows)


def test_empty_table_and_dropped_rows(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert _got(cr.repair(cr.damage(spark.createDataFrame([], schema)))) == {}
    gone = next(f"c{i}" for i in range(1000) if zlib.crc32(f"c{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "All of it goes."), ("z" + gone, None, None, None)]
    assert _got(cr.repair(cr.damage(spark.createDataFrame(rows, schema)))) == _expected(rows)


def test_long_text(spark):
    rows = [("long", 0, "user", "word " * 400_000 + "end."), ("long", 1, "assistant", "Yes."), ("b", 0, "user", "Hm.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    assert _got(cr.repair(cr.damage(df))) == _expected(rows)
