"""Word windows and byte strings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import anchors, bwt_dedup, chunks, text, word_windows


def _documents(seed: int, n: int = 60):
    rng = random.Random(seed)
    words = ["a", "é", "the", "wörter", "x" * 9, "of", "tion", "漢字"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(
                rng.choice(words) + str(rng.randint(0, 999)) for _ in range(rng.randint(1, 30))))
        rows.append((i * 7 % n, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "one"), (n + 3, "z " * 400), (n + 4, "ab" * 300), (n + 5, rows[3][1])]
    return rows


def _windows(rows, w):
    seen, out = set(), {}
    for doc, value in sorted(rows, key=lambda r: r[0]):
        words = (value or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - w + 1):
            key = tuple(words[i : i + w])
            if key in seen:
                gone[i : i + w] = [True] * w
            seen.add(key)
        kept = b" ".join(x for x, g in zip(words, gone, strict=True) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def _strings(rows, size):
    first, out = {}, {}
    data = {d: (v or "").encode() for d, v in rows}
    for doc in sorted(data):
        for i in range(len(data[doc]) - size + 1):
            first.setdefault(data[doc][i : i + size], doc)
    for doc, raw in data.items():
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc:
                gone[i : i + size] = [True] * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("window", [20, 5, 1])
def test_word_windows(spark, window):
    rows = _documents(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumn("n_words", F.lit("x")).withColumn("chunk", F.lit(1))
    got = word_windows.remove_repeated_windows(docs, window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got} == _windows(rows, window)


@pytest.mark.parametrize("size", [50, 8])
def test_byte_strings(spark, size):
    rows = _documents(size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("bucket", F.lit(1))
    got = bwt_dedup.remove_repeated_bytes(docs, size).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_bytes)) for r in got} == \
        _strings(rows, size)


def test_rows_of_one_doc_id_and_null_doc_id(spark):
    value = " ".join(f"w{i}" for i in range(40))
    rows = [(None, value), (3, value), (3, value), (3, "other " * 3), (5, value)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    words = sorted((r.doc_id or -1, r.n_removed) for r in word_windows.remove_repeated_windows(docs).collect())
    assert words == [(-1, 0), (3, 0), (3, 40), (3, 40), (5, 40)]
    rows = [(3, value), (3, value), (5, value)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sizes = sorted((r.doc_id, r.n_removed) for r in bwt_dedup.remove_repeated_bytes(docs).collect())
    assert sizes == [(3, 0), (3, 0), (5, len(value))]


def test_rows_of_one_doc_id_have_one_order(spark):
    """Two texts under one doc_id in several partitions: every run and every dealing gives the same rows."""
    value = " ".join(f"w{i}" for i in range(40))
    rows = [(3, value + " first"), (3, value + " second"), (3, "third " + value), (5, value), (3, value + " first")]
    found = set()
    for i in range(4):
        docs = spark.createDataFrame(rows[i:] + rows[:i], "doc_id long, text string").repartition(1 + i)
        got = word_windows.remove_repeated_windows(docs).collect()
        found.add(tuple(sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got)))
    assert len(found) == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert word_windows.remove_repeated_windows(docs).count() == 0
    assert bwt_dedup.remove_repeated_bytes(docs).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    value = rng.integers(1, 3 + seed, 300).astype(np.uint16)
    value[rng.integers(0, 300, 9)] = 0
    order = bwt_dedup.suffix_array(value, 20)
    raw = value.astype(np.uint8).tobytes()
    prefixes = [raw[i : i + 20] for i in order]
    assert [p for p in prefixes] == sorted(prefixes)
    got = bwt_dedup.common_prefixes(value, order, 20)

    def common(a, b):
        n = 0
        while n < 20 and a + n < len(raw) and b + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert got[0] == 0
    assert [common(a, b) for a, b in zip(order[:-1], order[1:], strict=True)] == got[1:].tolist()


def test_words_and_windows_of_a_slice():
    texts = ["a bc\x0b d", "", "  ", "é\x1cf", "x y z x y z"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, owner = text.words(data, off)
    raw = data.tobytes()
    assert [raw[a:b] for a, b in zip(starts, ends, strict=True)] == [w for t in texts for w in t.encode().split()]
    assert owner.tolist() == [0, 0, 0, 3, 4, 4, 4, 4, 4, 4]
    h = text.range_hash(text.prefix_sums(data), starts, ends)
    for width in (1, 2, 3, 5, 7, 10):
        w = text.window_hash(h, width)
        assert len(w) == max(0, len(h) - width + 1)
    three = text.window_hash(h, 3)
    assert three[4] == three[7] and len(set(three.tolist())) == len(three) - 1


LICENSE = "Licensed under the terms of the common form, by "


def _forms(n: int):
    rng = random.Random(n)
    names = ["".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(n)]
    # Every third document repeats the neighbours of another one: its strings over the license are to go.
    names = [names[i // 2] if i % 3 == 0 else x for i, x in enumerate(names)]
    return [(i * 7919 % n, x + LICENSE + x[::-1]) for i, x in enumerate(names)]


@pytest.mark.parametrize(("size", "hot"), [(50, 0), (50, 2), (51, 5), (8, 3), (1, 2), (50, 10**6)])
def test_byte_strings_of_hot_anchors(spark, size, hot):
    rows = _documents(size + 1) + [(d + 1000, v) for d, v in _forms(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = bwt_dedup.remove_repeated_bytes(docs, size, hot=hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_bytes)) for r in got} == \
        _strings(rows, size)


def test_no_key_of_a_hot_anchor_gathers_a_stretch_per_occurrence():
    made = []
    for c in range(2):
        values = [v.encode() for _, v in _forms(3000 + c)]
        data = np.frombuffer(b"".join(values), np.uint8)
        off = np.cumsum([0, *map(len, values)])
        made.append(chunks.Chunk(f"c{c}", None, np.arange(len(values)), data, off, []))
    stretches, asked = [bwt_dedup._Stretches(c, 50) for c in made], {}
    for s, c in zip(stretches, made, strict=True):
        for cell in s.anchors.ask_with_times(c.name, 4).to_pylist():
            asked.setdefault(cell["bucket"], []).append(cell)
    answers = {c.name: {} for c in made}
    for bucket, cells in asked.items():
        for cell, bits in zip(cells, anchors.in_several_chunks_and_hot(cells, bwt_dedup.HOT), strict=True):
            answers[cell["chunk"]][bucket] = np.packbits(bits).tobytes()
    sent = {}
    for s, c in zip(stretches, made, strict=True):
        _, _, key, same, texts = s.stretches(answers[c.name], 4)
        first = np.flatnonzero(same == np.arange(len(same)))
        assert sorted(texts) == first.tolist()
        for k in key[first].tolist():
            sent[k] = sent.get(k, 0) + 1
    assert max(sent.values()) <= bwt_dedup.HOT


def test_rounds_look_at_places_without_a_boundary(monkeypatch):
    rng = np.random.default_rng(3)
    passage = rng.integers(1, 5, 300)
    text = np.concatenate([x for _ in range(40) for x in (rng.integers(1, 5, 300), passage, [0])]).astype(np.uint16)
    order = bwt_dedup.suffix_array(text, 50)
    seen, real = [], np.cumsum
    monkeypatch.setattr(bwt_dedup.np, "cumsum", lambda a, *rest, **more: (seen.append(len(a)), real(a, *rest, **more))[1])
    got = bwt_dedup.common_prefixes(text, order, 50)
    monkeypatch.undo()
    assert sum(seen) < 40 * len(text)  # 49 rounds over all places before
    padded = np.concatenate([text, np.zeros(50, np.uint16)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 50)[order]
    differ = (windows[1:] != windows[:-1]) | ((np.arange(50) + order[1:, None]) >= len(text)) | ((np.arange(50) + order[:-1, None]) >= len(text))
    assert got[1:].tolist() == np.where(differ.any(axis=1), differ.argmax(axis=1), 50).tolist()


def test_a_stretch_alone_under_its_anchor_is_not_sorted(monkeypatch):
    def cell(*entries):
        raw = b"".join(t for t, _, _ in entries)
        docs = np.diff([d for _, d, _ in entries], prepend=0).astype(np.int64)
        extra = np.array([k for _, _, k in entries], np.uint32).tobytes() + np.array([len(t) for t, _, _ in entries], np.uint32).tobytes()
        return {"entries": bwt_dedup.zstandard.ZstdCompressor().compress(raw), "docs": docs.tobytes(), "extra": extra}

    shared = bytes(range(60))
    rows = [cell((b"a" * 55, 1, 7), (shared, 2, 9)), cell((b"a" * 55, 3, 7), (b"x" + shared[:55], 4, 9))]
    sorted_, real = [], bwt_dedup.removable
    monkeypatch.setattr(bwt_dedup, "removable", lambda strings, *a: (sorted_.extend(strings), real(strings, *a))[1])
    got = [x.astype(int).tolist() for x in bwt_dedup._decide(rows, 50)]
    assert got == [[0] * 6 + [0] * 11, [1] * 6 + [0] + [1] * 6]
    assert sorted(sorted_) == sorted([shared, b"x" + shared[:55]])
