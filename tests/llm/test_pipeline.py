"""The pipeline's stages on a small corpus, each against what its operator returns, and whole."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    path = tmp_path_factory.mktemp("corpus")
    rows = []
    for i in range(120):
        lines = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(15)) for _ in range(4)]
        rows.append([i, "\n".join(lines), rng.choice(["en", "de"]), f"src{i % 20}"])
    near = rows[3][1].split(" ")
    near[30] = "changed"
    shared = rows[10][1].split("\n")[0]
    rows += [[200, " ".join(near), "en", "src3"], [201, rows[4][1], "en", "src4"], [202, None, "en", "src0"],
             [203, "few words", None, None], [204, "new text " * 3 + "\n" + shared + "\n" + " ".join(f"q{i}" for i in range(20)), "en", None],
             [205, "w " * 2000, "en", "src1"], [None, " ".join(f"z{i}" for i in range(30)), "en", "src2"]]
    table = [(*r, len(r[1] or "")) for r in rows]
    spark.createDataFrame(table, COLUMNS).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int").write.parquet(str(path / "labels.parquet"))
    return str(path), table


def _stage(spark, corpus, number):
    path, table = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = corpus_pipeline.STAGES[number][1](spark, docs, path)
    if number < 4:
        assert out.columns == docs.columns
    return out, {r[0]: r for r in table}


def test_stage_names_and_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_runs", "near_duplicates", "mixing", "bpe"]


def test_quality_stage(spark, corpus):
    out, table = _stage(spark, corpus, 0)
    assert {r.doc_id for r in out.collect()} == set(table) - {202, 203, 205}


def test_line_stage(spark, corpus):
    out, table = _stage(spark, corpus, 1)
    got = {r.doc_id: r for r in out.collect()}
    assert 201 not in got  # every line of it is a later copy
    assert got[204].text.count("\n") == 1 and got[204].n_chars == len(got[204].text)
    assert got[5].text == table[5][1]


def test_near_duplicate_stage(spark, corpus):
    out, table = _stage(spark, corpus, 2)
    assert Counter(r.doc_id for r in out.collect()) == Counter(set(table) - {200, 201})


def test_mixing_stage(spark, corpus):
    out, table = _stage(spark, corpus, 3)
    rows = out.collect()
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
    total = sum(len((r[1] or "").split()) for r in table.values())
    assert 0.5 * total < sum(len((r.text or "").split()) for r in rows) <= total


def test_bpe_stage(spark, corpus):
    out, table = _stage(spark, corpus, 4)
    library = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    for r in out.collect():
        assert r.ids == library.encode(table[r.doc_id][1] or "", add_special_tokens=False).ids


def test_whole_pipeline(spark, corpus):
    path, table = corpus
    rows = corpus_pipeline.run(spark, path).collect()
    # Document 200 stays with the one line that differs; the others are rejected or copies.
    assert rows and {r.doc_id for r in rows} <= {r[0] for r in table} - {201, 202, 203, 205}
    assert all(r.n_tokens == len(r.ids) > 0 for r in rows)
