"""Quality rules and mixing against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, quality

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measures(value):
    value = value or ""
    words = _WORD.findall(value)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in value.split("\n") if _WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in value), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    rng = random.Random(1)
    pool = ["a", "béta", "#x", "漢字", "|", "a|b", "the", "\n", "\t", "  ", "\x1c", " "]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "ab cd ef gh ij\n" * 3), (503, "w " * 50_000), (503, "x")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_words int")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality.text_measures(docs, "doc_id").collect())
    assert got == Counter((d, *_measures(t)) for d, t in rows)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 50, 0.02), (7, 400, 0.03), (5, 5, 0.5)])
def test_binomial(k, n, p):
    exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
    assert quality.binomial_at_most(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def test_cutoff_walk():
    assert quality.safe_cutoff([0, 0, 0], 10, 0.01, 0.05) is None  # too few labels to prove anything
    assert quality.safe_cutoff([0, 0, 1, 2, 60, 0], 3000, 0.01, 0.001) == 3
    assert quality.safe_cutoff([], 100, 0.01, 0.05) is None


def test_the_cutoff_that_gains_most():
    good, bad = [0, 0, 0, 5, 9], [0, 40, 40, 41, 41]
    assert quality.best_cutoff(good, bad, 3000, 50, 0.01, 0.001) == 3
    assert quality.best_cutoff(good, bad, 3000, 5000, 0.01, 0.001) == 2
    assert quality.best_cutoff([0, 0, 5], [0, 0, 0], 3000, 50, 0.01, 0.001) is None
    assert quality.best_cutoff([0], [9], 50, 50, 0.01, 0.001) is None


def test_path_takes_what_catches_most_for_least():
    counts = {"a": ([0, 5, 0, 0, 0, 0], [0, 1, 0, 0, 0, 9]), "b": ([0, 0, 8, 1], [0, 0, 0, 6]), "c": ([0, 0], [3, 3])}
    path = quality.draw_path(counts, 10, 20)
    # b's first pool, then a's with half of the untouched steps behind it, then what is left of b; never c.
    assert path == [("b", 0, 0), ("b", 1, 1), ("b", 2, 1), ("a", 0, 2), ("a", 1, 3), ("a", 2, 3), ("b", 3, 4)]
    assert quality.draw_path({"a": ([0, 0], [1, 0])}, 0, 1) == []


def _brute_cutoffs(docs, labels, risk=0.02, error=0.05):
    """Cutoffs of one stratum, in plain Python: the path from bad and unlabelled rows, the walk on good ones."""
    told = dict(labels)
    rows = {"good": [], "bad": [], "other": []}
    for i, text in docs:
        words, chars, symbols, dups, repeats = _measures(text)
        if words < 10 or 100 * repeats > 20 * words:
            continue
        lines = len([x for x in text.split("\n") if _WORD.search(x)])
        odd = sum(not re.search("[A-Za-z]|[^\x00-\x7f]", w) for w in _WORD.findall(text))
        values = {"symbols": symbols / words, "odd_words": odd / words, "repeats": repeats / words,
                  "dup_lines": dups / lines, "long_words": chars / words}
        rows[{None: "other", 0: "bad", 1: "good"}[told.get(i)]].append(values)
    rejects = lambda r, step, v: v[r.name] > r.grid[step]
    counts = {}
    for r in quality.RULES:
        upto = [[sum(rejects(r, s, v) for v in rows[kind]) for s in range(len(r.grid))] for kind in ("bad", "other")]
        counts[r.name] = tuple([x - y for x, y in zip(u, [0, *u], strict=False)] for u in upto)
    path = quality.draw_path(counts, len(rows["bad"]), len(rows["other"]))
    rules, now, lost, caught, vectors = {r.name: r for r in quality.RULES}, {}, [], [], []
    for at in range(path[-1][2] + 1 if path else 0):
        now = {**now, **{name: step for name, step, place in path if place == at}}
        hit = {k: sum(any(rejects(rules[n], s, v) for n, s in now.items()) for v in rows[k]) for k in ("good", "bad")}
        n, k = len(rows["good"]), hit["good"]
        tail = sum(math.comb(n, j) * Fraction(risk) ** j * (1 - Fraction(risk)) ** (n - j) for j in range(k + 1))
        if k > n * risk or tail > error:
            break
        lost.append(k / n)
        caught.append(hit["bad"] / max(1, len(rows["bad"])))
        vectors.append(now)
    gain = [c - x for c, x in zip(caught, lost, strict=True)]
    if not gain or max(gain) <= 0:
        return {}
    equal = [i for i, g in enumerate(gain) if abs(g - max(gain)) < 1e-12]
    return {n: (s, rules[n].grid[s]) for n, s in vectors[equal[len(equal) // 2]].items()}


def _noisy(seed, n, first=0):
    """Good and bad texts that overlap, of one stratum; a third has no label."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(first, first + n):
        bad = rng.random() < 0.2
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
        for k in range(rng.choice([4, 9, 14]) if bad and rng.random() < 0.8 else rng.choice([0] * 12 + [1, 2])):
            words[k] = rng.choice(["#", "%%", "||"])
        text = "\n".join(" ".join(words[k : k + 8]) for k in range(0, 40, 8))
        if bad and rng.random() < 0.5:
            text += "\n" + "\n".join([words[-1]] * 3)
        rows.append((i, text, bad))
        if rng.random() < 0.66:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_cutoffs_against_brute_force(spark):
    rows, labels = _noisy(3, 700)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, stratum string")
    measures = quality.text_measures(docs, "doc_id", "stratum")
    got = {r.rule: (r.step, r.cutoff) for r in quality.choose_cutoffs(measures, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    want = _brute_cutoffs([(i, t) for i, t, _ in rows], labels)
    assert got == want and "symbols" in got


def test_three_hundred_good_labels_suffice_and_little_is_lost(spark):
    """Sixteen strata with their own labels: rules take effect, and unseen good documents are kept."""
    rows, labels = [], []
    for s in range(16):
        own, told = _noisy(100 + s, 700, first=s * 10_000)
        rows += [(i, t, f"s{s}", bad) for i, t, bad in own]
        labels += told
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, bad boolean")
    seen = {i for i, _ in labels}
    lost, total, caught, junk = Counter(), Counter(), 0, 0
    strata = {i: (s, bad) for i, _, s, bad in rows}
    cut = quality.quality_verdicts(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    for r in cut.collect():
        s, bad = strata[r.doc_id]
        if bad:
            junk, caught = junk + 1, caught + (not r.kept)
        elif r.doc_id not in seen:
            total[s] += 1
            lost[s] += not r.kept
    assert 0.3 * junk < caught
    assert sum(lost.values()) <= 0.02 * sum(total.values())


@pytest.mark.parametrize("over", [True, False])
def test_grid_index(spark, over):
    for own in quality.RULES:
        rule = quality.Rule(own.name, "v", over, own.grid if over else own.grid[::-1])
        values = {x + d for x in rule.grid for d in (0.0, 1e-9, -1e-9, 0.004)} | {-5.0, 0.0, 1e12}
        rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", quality._grid_index(rule).alias("step"))
        for r in rows.collect():
            hit = [i for i, g in enumerate(rule.grid) if (r.v > g if over else r.v < g)]
            assert r.step == (hit[0] if hit else len(rule.grid))


def _corpus(n=14_000):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        if bad:
            words = [w + "###" for w in words]
        elif rng.random() < 0.001:
            words[:3] = ["#", "%", "&"]
        rows.append((i, " ".join(words), None if i % 3 == 0 else "en", "x"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_rules_reject_junk_and_few_good_documents(spark):
    rows, labels = _corpus()
    rows += [(20_000, None, "en", "x"), (20_001, "", "xx", "x"), (20_002, " ".join(f"v{i}" for i in range(20)), "xx", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    table = spark.createDataFrame([*labels, (4, 0), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_verdicts(docs, table).collect()}
    assert len(got) == len(rows)
    good = [r for i, r in got.items() if i < 14_000 and i % 5]
    assert sum(not r.kept for r in good) <= 0.01 * len(good)
    assert not any(r.kept for i, r in got.items() if i < 14_000 and i % 5 == 0)
    assert not got[20_000].kept and got[20_000].base_failed and not got[20_001].kept
    assert got[20_002].kept  # no label in its stratum: the base rule alone
    cutoffs = quality.choose_cutoffs(
        quality.text_measures(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "text"), "doc_id", "stratum"), table
    ).collect()
    assert {r.stratum for r in cutoffs} <= {"", "en"}
    symbols = [r.cutoff for r in cutoffs if r.rule == "symbols"]
    assert symbols and all(0.02 <= c < 2.0 for c in symbols)
    assert quality.quality_verdicts(docs.limit(0), table).count() == 0
    assert quality.quality_verdicts(docs, table.limit(0)).filter("NOT kept").count() == 2


def test_share():
    assert mixing.share(100, [1, 1], [30, 1000]) == [30, 70]
    assert mixing.share(100, [3, 1, 0], [1000, 1000, 1000]) == [75, 25, 0]
    assert mixing.share(100, [1, 1], [10, 20]) == [10, 20]


def test_budgets_go_to_siblings_first():
    supply = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000}
    given = mixing.budgets(supply, {("a",): 1, ("b",): 1}, 200, 1)
    assert given == {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 100}
    supply = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 1000}
    assert mixing.budgets(supply, {}, 200, 2) == {("a", "x"): 20, ("a", "y"): 40, ("b", "x"): 140}


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 12)), rng.choice(["en", "de", None]), "s0" if rng.random() < 0.4 else f"s{i % 4}")
            for i in range(400)]
    rows += [(7, "again and again", "en", "s0"), (7, "again and again", "en", "s0"), (None, None, None, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, bucket int")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {("en",): 3.0, ("de",): 1.0, ("",): 1.0}
    got = mixing.mix(docs, levels, weights, budget_share=0.9, max_epochs=3)
    assert got.columns == [*docs.columns, "mix_path", "mix_epoch"]
    leaf = lambda r: ((r[2] or ""), (r[3] or ""))
    size = lambda t: len((t or "").split())
    supply = Counter()
    for r in rows:
        supply[leaf(r)] += size(r[1])
    given = mixing.budgets(supply, weights, 0.9 * sum(supply.values()), 3)
    taken, copies = Counter(), Counter()
    for r in got.collect():
        taken[tuple(r.mix_path)] += size(r.text)
        copies[tuple(r.mix_path), r.doc_id, r.text] += 1
        assert tuple(r.mix_path) == leaf((0, 0, r.lang, r.source)) and r.bucket == 1
    for path, budget in given.items():
        longest = max(size(r[1]) for r in rows if leaf(r) == path) * 2
        assert budget - longest <= taken[path] <= budget
        whole = budget // supply[path] if supply[path] else 0
        for (p, _, _), n in copies.items():
            if p == path:
                assert whole <= n / (2 if n >= 2 * max(1, whole) else 1) <= whole + 1
    again = mixing.mix(docs.repartition(9), levels, weights, budget_share=0.9, max_epochs=3)
    assert Counter((r.doc_id, r.mix_epoch) for r in again.collect()) == Counter((r.doc_id, r.mix_epoch) for r in got.collect())
    assert mixing.mix(docs.limit(0), levels, weights).count() == 0


def _brute_budgets(supply, weights, total, epochs):
    """Budgets by many small drops, each poured down the tree past what is full: siblings first, then ancestors."""
    from fractions import Fraction as Q

    def pour(node, amount):
        """Fill the subtree; siblings share by weight, round after round, until all are full or nothing is left."""
        if node in supply:
            given[node] = min(amount, Q(supply[node] * epochs))
            return
        below = sorted({leaf[: len(node) + 1] for leaf in supply if leaf[: len(node)] == node and len(leaf) > len(node)})
        room = {c: Q(sum(n for leaf, n in supply.items() if leaf[: len(c)] == c) * epochs) for c in below}
        part = dict.fromkeys(below, Q(0))
        left = min(amount, sum(room.values()))
        while left > 0:
            thirsty = [c for c in below if part[c] < room[c] and weights.get(c, 1) > 0]
            if not thirsty:
                break
            weight = {c: Q(weights.get(c, 1)) for c in thirsty}
            # The largest level at which no one overflows, then again among those with room.
            level = min(min((room[c] - part[c]) / weight[c] for c in thirsty), left / sum(weight.values()))
            for c in thirsty:
                part[c] += level * weight[c]
            left -= level * sum(weight.values())
        for c in below:
            pour(c, part[c])

    given = {}
    pour((), Q(total))
    return {leaf: int(x + Q(1, 10**6)) for leaf, x in given.items()}


def test_mixing_takes_exactly_the_prefix(spark, monkeypatch):
    """Each leaf's copies, one by one: budgets by pouring, prefixes by sorting the leaf."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rng = random.Random(21)
    rows = [(i, f"t{rng.randint(0, 10**6)} " + " ".join(["w"] * rng.randint(0, 9)), "en" if rng.random() < 0.7 else "de",
             "hot" if rng.random() < 0.5 else f"s{i % 3}") for i in range(900)]
    rows += [rows[5]] * 40 + [(7, None, "en", "hot"), (7, "", "en", "hot"), (None, "one two three", "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    weights = {("en",): 1.0, ("de",): 3.0, ("en", "hot"): 2.0}
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = Counter((r.doc_id, r.text, r.mix_epoch) for r in mixing.mix(docs, levels, weights, 0.8, 2, seed=4).collect())
    keyed = docs.select("doc_id", "text", F.array(F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))).alias("path"),
                        *[F.xxhash64(F.lit(4), F.lit(e), F.col("doc_id"), F.xxhash64("text")).alias(f"key{e}") for e in range(3)]).collect()
    supply = Counter()
    for r in keyed:
        supply[tuple(r.path)] += len((r.text or "").split())
    given = _brute_budgets(supply, weights, 0.8 * sum(supply.values()), 2)
    want = Counter()
    for leaf, budget in given.items():
        own = [r for r in keyed if tuple(r.path) == leaf]
        whole, rest = divmod(budget, supply[leaf]) if supply[leaf] else (0, 0)
        for r in own:
            want.update((r.doc_id, r.text, e) for e in range(whole))
        keys, spent = sorted({r[f"key{whole}"] for r in own}), 0
        for key in keys if rest else []:
            equal = [r for r in own if r[f"key{whole}"] == key]
            spent += sum(len((r.text or "").split()) for r in equal)
            if spent > rest:
                break
            want.update((r.doc_id, r.text, whole) for r in equal)
    assert got == want and len(set(given.values())) > 2
