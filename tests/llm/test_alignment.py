"""Alignment against the definitions, token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment as al
from tidemark.llm.bpe import printable_bytes

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_file=SECOND)


def _tokens(text, first, second):
    """[(id, bytes)] of both sides by the libraries."""
    to_byte = printable_bytes()
    a = first.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(to_byte[c] for c in first.id_to_token(i))) for i in a]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def _expected(rows, first, second):
    per_doc, holders = [], Counter()
    for doc_id, text in rows:
        a, b = _tokens(text, first, second) if text else ([], [])
        ends = [set(), set()]
        for side, tokens in enumerate((a, b)):
            at = 0
            for _, x in tokens:
                at += len(x)
                ends[side].add(at)
        cuts = sorted(ends[0] & ends[1])
        parts = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            at, g = 0, 0
            for i, x in tokens:
                at += len(x)
                while at > cuts[g]:
                    g += 1
                parts[g][side].append(i)
        links = Counter()
        for x, y in parts:
            links.update((i, j) for i in x for j in y)
        holders.update(links.keys())
        per_doc.append((doc_id, len(a), len(b), parts, links))
    best = defaultdict(int)
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, n_a, n_b, parts, links in per_doc:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in parts)
        out.append((
            doc_id, n_a, n_b, len(parts), sum(links.values()),
            sum(n for p, n in links.items() if holders[p] == best[p[0]]), sum(n * holders[p] for p, n in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if parts else "",
        ))
    return sorted(out, key=str)


def _texts():
    rng = random.Random(6)
    words = ["the", "house", "übrigens", "naïve", "don't", "x9", "42", "Étion", "日本語", "🙂", "a\tb", "aaaaaaaaaaaa", "<s>",
             "<|endoftext|>", "end.\nNew", "...", "▁", "é", " ", "\x85", "ﬁ", "\x1c", "--", "http://x.y/z?q=1"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(120)]
    texts += ["", " ", "  ", " lead", "trail ", "two  spaces", "\n", "a", "﻿bom", "<unk>", "x" * 3000, " " * 3000, "日" * 500]
    texts += ["".join(rng.choices("ab cd\n\tÉß 12.,'s", k=rng.randint(0, 80))) for _ in range(150)]
    return texts


def _got(df, **limits):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in names) for r in al.align(df, FIRST, SECOND, **limits).collect()), key=str)


def test_alignment(spark, tokenizers):
    rows = list(enumerate(_texts())) + [(7, "the house"), (7, "the house"), (None, "the house"), (9000, None)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, chunk string")
    want = _expected(rows, *tokenizers)
    assert _got(df.repartition(4)) == want
    # Many small chunks, of which two at a time ask a bucket.
    assert _got(df.repartition(2), chunk_bytes=300, asked=2) == want


def test_empty_table(spark):
    assert _got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_long_text_and_large_group(spark, tokenizers):
    rng = random.Random(1)
    long = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(300_000))
    rows = [(1, long), (2, "日" * 3000 + "x" * 5001), (3, "short.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(df) == _expected(rows, *tokenizers)


@pytest.mark.parametrize("step", [1, 2, 3, 7, 100])
def test_merge_path(step):
    rng = np.random.default_rng(step)
    for _ in range(60):
        end = int(rng.integers(1, 80))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, rng.integers(0, end)), end)) for _ in range(2))
        ga, gb, cuts = al.groups(a, b, step)
        want = np.intersect1d(a, b)
        assert (cuts == want).all()
        assert (ga == np.searchsorted(want, a)).all() and (gb == np.searchsorted(want, b)).all()
        i, j = al.merge_path(a, b, step)
        assert i[0] == j[0] == 0 and i[-1] == len(a) and j[-1] == len(b)
        assert (np.diff(i) + np.diff(j) <= step + 1).all()


def test_pieces_change_nothing():
    first, second = al.byte_tokens(FIRST), al.piece_tokens(SECOND)
    texts = _texts()
    want = al.aligned(texts, first, second)
    for limit, step in ((1, 5), (13, 1), (60, 64)):
        got = al.aligned(texts, first, second, limit, step)
        assert all(np.array_equal(got[k], want[k]) for k in want), limit
