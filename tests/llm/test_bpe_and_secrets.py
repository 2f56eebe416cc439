"""BPE against the tokenizers library; secret spans against plain regular expressions."""

from __future__ import annotations

import hashlib
import random
import re
import string

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries, secret_scan

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = bpe.codec(PATH)
SPECIAL = "<|endoftext|>"


def _same(value: str) -> None:
    want = LIBRARY.encode(value, add_special_tokens=False).ids
    assert CODEC.encode(value) == want
    assert CODEC.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(value):
    _same(value)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["the", " of", "tion", "'s", " ", "\n", "\t", "123", "é", "漢", SPECIAL, "<|end", "##", "՘"]),
                max_size=30))
def test_joined_pieces(parts):
    _same("".join(parts))


def test_long_words():
    for value in ("a" * 5000, "ab" * 2000, " " * 3000, "é" * 999, "abcdefghij" * 300):
        _same(value)


def test_many_words_at_once():
    rng = random.Random(11)
    parts = ["th", "er", "ing", "tion", "é", "漢", "0", "7", "ß", "_", "-", "a", "zq", "\u0301"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(3000)]
    texts = [" ".join(words[i : i + 7]) for i in range(0, 3000, 7)] + ["", " ", SPECIAL, "x" + SPECIAL * 2 + " y"]
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [list(memoryview(p).cast("i")) for p in CODEC.packed(texts)] == want


def test_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    codec = bpe.Codec(PATH)
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join(rng.choices(["one", "two", "threefold", "xyzzyx", "ninety"], k=9)) + f" w{rng.randint(0, 99)}"]
        assert [list(memoryview(p).cast("i")) for p in codec.packed(texts)] == [
            e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
        assert len(codec.runs) <= 40


def test_every_token_is_its_own_encoding():
    assert all(CODEC._whole(i) for i in CODEC.rank)


def test_documents(spark):
    rows = [(1, "Hello world 12"), (2, None), (3, ""), (3, "x" + SPECIAL), (None, "né")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, ids int")
    got = bpe.encode(docs, PATH)
    want = sorted((d or 0, LIBRARY.encode(t or "", add_special_tokens=False).ids) for d, t in rows)
    assert sorted((r.doc_id or 0, r.ids) for r in got.collect()) == want
    assert sorted((r.doc_id or 0, r.text) for r in bpe.decode(got, PATH).collect()) == \
        sorted((d or 0, t or "") for d, t in rows)
    digests = {(r.doc_id, r.n_tokens): r for r in bpe.round_trip(docs, PATH).collect()}
    ids = LIBRARY.encode(rows[0][1], add_special_tokens=False).ids
    row = digests[1, len(ids)]
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(rows[0][1].encode()).hexdigest()
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def _plain(value: str) -> str:
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", value, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end(), "assign"))
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", value) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", value) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_base_spans(spark, tmp_path):
    rng = random.Random(2)
    parts = ["password", "=", ": ", "'", '"', "AKIA", "ABCDEFGH12345678", "deadbeef" * 2, "0123456789abcdef01", "tokeN",
             "api_key", "apikey", "SECRET", "é", "漢", " ", "\n", "short", "aVeryLongValue/With+Signs", "ſecret", "key"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "x" * 3_000_000 + " token = " + "ab12" * 9)]
    spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, found string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op1_secret_scan(spark, str(tmp_path)).collect()}
    for doc, value in rows:
        base = _plain(value or "")
        assert got[doc].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        kept = [s for s in got[doc].spans.split(",") if s and not s.startswith("novel")]
        assert ",".join(kept) == base
        assert got[doc].n_hex == base.count("hex:") and got[doc].n_assign == base.count("assign:")


@pytest.mark.parametrize(("value", "found"), [
    ("the bearer of q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3 came", True),
    ("credential of user_password_hash1 came", False),
    ("q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3 came alone", False),
    ("q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3 then the bearer of q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3 came", True),
    ("token q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3 q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3", True),
])
def test_novel_strings(value, found):
    spans = list(secret_scan.novel_spans(value, secret_scan.base_spans(value), secret_scan.Novelty()))
    assert bool(spans) is found
    assert all(value[a:b] == "q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3" for a, b, _ in spans)


KEY = "q7Xv9Lz2Kd8Wm4Rt6Yp1Bn3Hs5Jc0Gf7"


@pytest.mark.parametrize(("value", "found"), [
    *[("bearer" + " " * gap + KEY + " came", gap <= 48) for gap in (1, 36, 37, 40, 47, 48, 49)],
    *[(KEY + " " * gap + "bearer came", gap <= 48) for gap in (1, 37, 48, 49)],
    (KEY + " # api token", True),
    ("bearer my_token_" + KEY, True),
    ("it is " + KEY + "_token", True),
])
def test_reach_of_sensitive_words(value, found):
    spans = list(secret_scan.novel_spans(value, secret_scan.base_spans(value), secret_scan.Novelty()))
    assert bool(spans) is found
    assert all(KEY in value[a:b] for a, b, _ in spans)


def test_a_string_between_two_words_is_told_once():
    value = "bearer " + KEY + " token"
    spans = list(secret_scan.novel_spans(value, [], secret_scan.Novelty()))
    assert [value[a:b] for a, b, _ in spans] == [KEY]


@pytest.mark.parametrize("alphabet", [string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase, string.digits])
@pytest.mark.parametrize("word", ["bearer", "credential", "private key"])
def test_keys_of_letters_or_digits_only(alphabet, word):
    rng, novelty = random.Random(word + alphabet), secret_scan.Novelty()
    for size in (16, 24, 40):
        key = "".join(rng.choice(alphabet) for _ in range(size))
        value = f"please send the {word} {key} to the office"
        base = secret_scan.base_spans(value)
        spans = base + list(secret_scan.novel_spans(value, base, novelty))
        assert [value[a:b] for a, b, _ in spans] == [key]


@pytest.mark.parametrize("word", [
    "authentication", "documentation", "implementation", "responsibility", "Representative", "Configuration",
    "internationally", "unfortunately", "malheureusement", "desafortunadamente", "----------------", "============",
])
def test_long_words_are_no_keys(word):
    value = f"the credential and {word} of the office"
    assert not list(secret_scan.novel_spans(value, [], secret_scan.Novelty()))
