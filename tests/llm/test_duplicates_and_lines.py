"""Near-duplicate classes and repeated lines against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import dart_minhash, line_dedup
from tidemark.llm.components import components


def _similarity(a: str, b: str) -> float:
    def units(t):
        w = (t or "").split()
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (Counter([tuple(w)]) if w else Counter())

    x, y = units(a), units(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


def _near_copies(seed=3):
    rng = random.Random(seed)
    rows = []
    for group in range(25):
        base = [f"g{rng.randint(0, 400)}" for _ in range(rng.randint(8, 300))]
        for _ in range(rng.randint(1, 5)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 9999)}"
            rows.append((len(rows) * 13 % 997, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, "just three words"), (2003, "just  three\nwords"), (2004, "two words"),
             (2005, "a a a a a a a a a a a"), (2006, rows[5][1]), (2007, rows[5][1]), (2007, rows[8][1])]
    return rows


def _classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if _similarity(a, rows[j][1]) >= 0.8:
                parent[root(i)] = root(j)
    return [min(rows[k][0] for k in range(len(rows)) if root(k) == root(i)) for i in range(len(rows))]


def test_near_duplicates(spark):
    rows = _near_copies()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    got = dart_minhash.near_duplicates(docs.repartition(3)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter(
        (d, c) for (d, _), c in zip(rows, _classes(rows), strict=True))
    assert {r.class_id for r in got if r.doc_id in (2002, 2003)} == {2002}
    assert dart_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_null_doc_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (None, "q r s t u v")], "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id) for r in dart_minhash.near_duplicates(docs).collect())
    assert got == Counter([(None, 4), (4, 4), (None, None)])


def test_texts_of_one_doc_id_are_told_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(7, a), (7, b), (9, b), (11, a), (None, a), (None, "c d e f g h"), (None, "c d e f g h"), (12, ""), (12, None)]
    got = dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter(
        [(7, 7), (7, 7), (9, 7), (11, 7), (None, 7), (None, None), (None, None), (12, 12), (12, 12)])
    # Class ids are doc_ids, so two classes may have one; the texts tell them apart.
    assert len({r.text_key for r in got if r.class_id == 7}) == 2
    assert sorted((r.doc_id or 0, r.text_key) for r in got if r.chosen and r.class_id == 7) == sorted(
        (7, k) for k in {r.text_key for r in got if r.class_id == 7})


def test_links_across_a_band_are_found(spark):
    """Copies of copies: neighbours are similar, ends are not, and all are one class."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((99 - i if i % 2 else i, " ".join(words)))
        words[rng.randrange(200)] = f"n{i}"
    got = dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == set(_classes(rows))


def test_links_across_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(dart_minhash, "BLOCK", 4)
    monkeypatch.setattr(dart_minhash, "COLUMNS", 16)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(30):
        words = list(base)
        for k in rng.sample(range(80), i % 4):
            words[k] = f"e{i}_{k}"
        texts.append((i, " ".join(words)))
    pack = dart_minhash.zstandard.ZstdCompressor().compress
    key = lambda i: bytearray([i])
    packed = spark.createDataFrame([(key(i), bytearray(pack(t.encode()))) for i, t in texts], "node binary, packed binary")
    bands = spark.createDataFrame([(key(i), b) for i, _ in texts for b in (7, 9)], "node binary, band long")
    labels = spark.createDataFrame([(key(4), key(4)), (key(8), key(4))], "node binary, label binary")
    links = dart_minhash._rest(bands, labels, packed, str(tmp_path / "mixed"))
    label = {i: i for i, _ in texts} | {8: 4}
    for r in components(links).collect():
        for i in label:
            if label[i] == r.node[0]:
                label[i] = r.label[0]
    assert [label[i] for i, _ in texts] == _classes([*texts])


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    shared = [f"s{i}" for i in range(300)]
    pairs = []
    for part in (0.5, 0.8, 0.95):
        n = int(300 * part)
        a = shared[:n] + [f"a{i}" for i in range(300 - n)]
        b = shared[:n] + [f"b{i}" for i in range(300 - n)]
        pairs.append((" ".join(a), " ".join(b)))
    del rng
    for a, b in pairs:
        sigs = []
        for t in (a, b):
            data = np.frombuffer(t.encode(), np.uint8)
            element, doc, _ = dart_minhash.elements(data, np.array([0, len(data)]))
            sigs.append(dart_minhash.signatures(element, doc, 1)[0])
        agree = float((sigs[0] == sigs[1]).mean())
        assert abs(agree - _similarity(a, b)) < 0.15


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def _lines_left(rows, min_lines, min_chars):
    docs = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    full = {r: [(i, x) for i, x in enumerate(r[1].split("\n")) if x.strip(" \t\r\x0b\x0c")] if r[1] else [] for r in docs}
    seen, out = set(), {}
    for r in docs:
        gone = set()
        texts = [x for _, x in full[r]]
        for n in range(len(texts)):
            if (texts[n],) in seen and len(texts[n]) >= min_chars:
                gone.add(full[r][n][0])
            seen.add((texts[n],))
            run = tuple(texts[n : n + min_lines])
            if len(run) == min_lines and min_lines > 1:
                if run in seen:
                    gone |= set(range(full[r][n][0], full[r][n + min_lines - 1][0] + 1))
                seen.add(run)
        lines = r[1].split("\n") if r[1] else []
        out[r] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


@pytest.mark.parametrize(("min_lines", "min_chars"), [(2, 50), (3, 1000), (5, 8), (4, 0)])
def test_repeated_lines(spark, min_lines, min_chars):
    rng = random.Random(min_lines)
    pool = [f"line {i} " + "x" * rng.randint(0, 70) for i in range(14)] + ["", "  ", "\t", "é" * 60]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(60)]
    rows += [(100, ""), (101, "\n".join(pool * 30)), (102, rows[3][1]), (102, rows[3][1]), (103, "\n\n")]
    docs = spark.createDataFrame([(*r, 5, "y") for r in rows] + [(104, None, 5, "y")],
                                 "doc_id long, text string, n_removed int, rank string").repartition(3)
    got = line_dedup.drop_repeated_lines(docs, min_lines, min_chars)
    assert got.columns == ["doc_id", "text", "rank", "kept_text", "n_lines", "n_removed"]
    want = _lines_left(rows, min_lines, min_chars)
    for r in got.collect():
        if r.doc_id == 104:
            assert (r.n_lines, r.n_removed, r.kept_text) == (0, 0, "")
        else:
            assert (r.n_lines, r.n_removed, r.kept_text) == want[r.doc_id, r.text]
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_null_doc_id_comes_first(spark):
    run = "a long line that is here twice, and more than fifty characters\nsecond"
    docs = spark.createDataFrame([(1, run), (None, run)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got == {None: 0, 1: 2}


def test_only_sql_functions(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string").withColumn("x", F.lit(1))
    plan = line_dedup.drop_repeated_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
