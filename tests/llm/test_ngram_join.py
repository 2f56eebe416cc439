"""Linked groups against all pairs compared one by one."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join as nj
from tidemark.llm import text as tx


def _set(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())


def _expected(rows):
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                parent[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i]:
            members.setdefault(root(i), []).append(doc_id)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(
        ((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str
    )


def _got(spark, rows, parts=3, **columns):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(parts)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.linked_groups(df).collect()), key=str)


def _copies(seed, groups, words, changes):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, changes)):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 9999)}"
            if rng.random() < 0.3:
                copy = copy[: -rng.randint(1, 5)] or copy
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    return rows


def test_groups(spark):
    rows = _copies(1, 40, 200, 3)
    rows += [(2000, None), (2001, ""), (2002, " \t"), (2003, "Two words"), (2004, "two\nWORDS"), (2005, "a a a a a a a"),
             (2006, rows[3][1]), (2006, rows[9][1].upper()), (None, rows[9][1]), (None, "alone with nobody else here"),
             (None, "only null copies of this"), (None, "only null copies of this"), (2007, "Ä ö ü é"), (2008, "ä ö ü é")]
    assert _got(spark, rows) == _expected(rows)


def test_hot_passage_and_chains(spark):
    """A passage in most documents; a chain whose ends share little; a group of near copies around no centre."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.choice([0, 2, 4, 60])))) for i in range(120)]
    words = [f"c{i}" for i in range(100)]
    for i in range(30):
        rows.append((1000 + i, " ".join(words[i * 4 : i * 4 + 100] + [f"c{k}" for k in range(100, 100 + 4 * i)])))
    assert _got(spark, rows, 5) == _expected(rows)


def test_blocks_of_a_large_group(spark, monkeypatch):
    """Many blocks for a group: the driver sets how many documents a block has."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    rng = random.Random(8)
    base = [f"h{i}" for i in range(60)]
    rows = []
    for i in range(80):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(base[: 60 - i])) for i in range(30)]
    assert _got(spark, rows, 4) == _expected(rows)


def test_empty_table(spark):
    assert _got(spark, []) == []


def test_long_text(spark):
    rng = random.Random(2)
    words = [f"L{rng.randint(0, 10**9)}" for _ in range(500_000)]
    other = list(words)
    for i in range(0, 500_000, 200):
        other[i] = "other"
    rows = [(1, " ".join(words)), (2, "\n".join(other)), (3, "short text of its own")]
    assert _got(spark, rows, 2) == _expected(rows)


def test_words_in_pieces():
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a", "bc", " ", "\n", "é"], k=rng.randint(0, 60))) for _ in range(50)]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    off = np.cumsum([0, *map(len, raw)])
    whole, count = tx.word_hashes(data, off, 1)
    assert count.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    for limit in (1, 2, 7, 30):
        pieces, again = tx.word_hashes(data, off, 1, limit)
        assert (pieces == whole).all() and (again == count).all()


@pytest.mark.parametrize("seed", range(4))
def test_products(seed):
    rng = np.random.default_rng(seed)
    rows = [np.unique(rng.integers(0, 9000, rng.integers(1, 3000)).astype(np.uint64)) for _ in range(12)]
    a, b = rows[:5], rows[5:]
    packed = [(np.array([len(r) for r in x]), np.concatenate(x)) for x in (a, b)]
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert nj.overlaps(*packed).astype(int).tolist() == want
