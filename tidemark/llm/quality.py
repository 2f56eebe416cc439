"""Quality rules whose cutoffs are set by the risk of rejecting good documents.

``text_measures`` counts, over whole texts, what the rules look at. ``choose_cutoffs`` uses
labelled documents as a holdout. All rules of a stratum are judged together, along one path of cutoff
vectors, from rejecting nothing to rejecting much. ``draw_path`` orders the path's steps, each of which
tightens one rule, by how many of the labelled bad documents a step catches for what it takes of the
documents without a label. The labelled good documents have no part in that, so for them the path is fixed
in advance: the walk along it is a fixed-sequence test. It goes on while an exact binomial
(Clopper-Pearson) bound shows that all rules together reject at most ``max_false_reject`` of the good
documents; its steps need no correction among themselves, strata are corrected by Bonferroni. Thus, with
probability ``1 - error``, no stratum loses more than ``max_false_reject`` of its good documents. With four
strata and 2 %, 217 good labels without a false rejection suffice. Among the safe steps that one is taken
that gains most. A rule that gains nothing is not used. A stratum with too few labels gets no cutoff: its
documents meet the base rules only.

Edge cases: a null text is an empty one (no words, base rule fails); a null stratum is the
stratum ``""``; repeated documents are judged row by row and calibrate once; a document labelled
twice is good only if all its labels say so; empty tables give empty results; extra columns are
dropped by the operator and kept by ``apply_rules`` callers through their own join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.session import workspace

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_odd_words")


@dataclass(frozen=True)
class Rule:
    """Rejects where ``value`` lies beyond a cutoff, for ``over`` above it, else below it.

    ``grid`` is fixed in advance, loosest cutoff first.
    """

    name: str
    value: str
    over: bool
    grid: tuple[float, ...]


def _steps(first: float, last: float, n: int) -> tuple[float, ...]:
    return tuple(float(x) for x in np.round(np.linspace(first, last, n), 6))


RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", True, _steps(2.0, 0.02, 100)),
    Rule("odd_words", "n_odd_words / greatest(n_words, 1)", True, _steps(0.99, 0.03, 97)),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", True, _steps(0.2, 0.05, 31)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", True, _steps(0.99, 0.1, 90)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", True, _steps(40.0, 6.0, 69)),
)


def _measure(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch, data, off in tx.sliced(batches):
        starts, ends, text = tx.words(data, off)
        n = len(off) - 1
        inside = tx.solid(data)
        lead = (data & 0xC0) != 0x80
        chars = tx.per_text(lead & inside, off)
        h = tx.range_hash(tx.prefix_sums(data, 7), starts, ends)
        w = tx.window_hash(h, WINDOW)
        at = np.flatnonzero(tx.windows_inside(text, WINDOW))
        key = tx.mix(w[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        repeated = tx.covered(len(starts), at[twice], WINDOW)
        count = np.bincount(text, minlength=n)
        # A word without an ASCII letter or a non-ASCII character is odd: numbers, bars, symbols.
        letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
        seen = np.zeros(len(data) + 1, np.int64)
        np.cumsum(letter, out=seen[1:])
        odd = seen[ends] == seen[starts]
        raw, dup, lines = data.tobytes(), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(n):
            full = [x for x in raw[off[i] : off[i + 1]].split(b"\n") if x.strip()]
            lines[i], dup[i] = len(full), len(full) - len(set(full))
        values = {
            "n_words": count,
            "word_chars": chars,
            "n_symbols": tx.per_text(_SYMBOLS[data], off),
            "n_dup_lines": dup,
            "n_repeat_words": np.bincount(text[repeated], minlength=n),
            "n_lines": lines,
            "n_odd_words": np.bincount(text[odd], minlength=n),
        }
        columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        yield pa.RecordBatch.from_arrays(
            columns + [pa.array(values[m].astype(np.int64)) for m in MEASURES], [*keep, *MEASURES]
        )


def text_measures(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the MEASURES of each row's ``text``; one row per row."""
    picked = docs.select(*keep, F.col("text").cast("string").alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    schema = ", ".join([*fields, *(f"{m} bigint" for m in MEASURES)])
    names = list(keep)
    return picked.mapInArrow(lambda batches: _measure(batches, names), schema)


def base_failed() -> Column:
    return F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the terms from k down, until they vanish."""
    if k >= n:
        return 1.0
    if k > n * p:  # terms would grow at first; the other tail's shrink
        return 1.0 - binomial_at_most(n - k - 1, n, 1.0 - p)
    top = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, term, i = 1.0, 1.0, k
    while i > 0 and term > total * 1e-18:
        term *= i * (1.0 - p) / ((n - i + 1) * p)
        total += term
        i -= 1
    return min(1.0, math.exp(top) * total)


def safe_cutoff(rejected: list[int], n: int, risk: float, error: float) -> int | None:
    """The last grid step whose false rejections are proven rare; ``rejected[i]`` of ``n`` at step i.

    ``binomial_at_most(k, n, risk) <= error`` says that the Clopper-Pearson upper bound of the
    rate, at confidence 1 - error, is at most ``risk``.
    """
    last = None
    for step, k in enumerate(rejected):
        if n == 0 or k > n * risk or binomial_at_most(int(k), int(n), risk) > error:
            break
        last = step
    return last


def _grid_index(rule: Rule) -> Column:
    """The first grid step that rejects the row; the grid's length if none does.

    The grid is even but for rounding: its arithmetic tells the step to within two, which are compared.
    """
    n, first = len(rule.grid), rule.grid[0]
    grid = F.array(*[F.lit(float(x)) for x in rule.grid])
    value = F.expr(rule.value).cast("double")
    place = (value - F.lit(first)) / F.lit((rule.grid[-1] - first) / (n - 1))
    near = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(n)), place))).cast("int")
    step = near
    for i in range(2):
        cutoff = F.get(grid, near + i)
        step = step + F.coalesce(value <= cutoff if rule.over else value >= cutoff, F.lit(False)).cast("int")
    return step


def _by_rule(rows: DataFrame, *keep: str) -> DataFrame:
    """One row for each row and rule: ``keep``, rule, step."""
    each = [F.struct(F.lit(r.name).alias("rule"), _grid_index(r).alias("step")) for r in RULES]
    return rows.select(*keep, F.explode(F.array(*each)).alias("s")).select(*keep, "s.rule", "s.step")


def best_cutoff(good: list[int], bad: list[int], n_good: int, n_bad: int, risk: float, error: float) -> int | None:
    """The safe grid step that gains most: share of bad documents caught less share of good ones lost.

    ``good[i]`` and ``bad[i]`` count what is rejected up to step i. Any
    choice among safe steps is safe. Of equal steps the middle one is taken, far from both sides.
    """
    last = safe_cutoff(good, n_good, risk, error)
    if last is None:
        return None
    gains = [b / max(1, n_bad) - g / n_good for g, b in zip(good[: last + 1], bad[: last + 1], strict=True)]
    if max(gains) <= 0:
        return None
    equal = [i for i, x in enumerate(gains) if x == max(gains)]
    return equal[len(equal) // 2]


def draw_path(counts: dict[str, tuple[list[int], list[int]]], n_bad: int, n_other: int) -> list[tuple[str, int, int]]:
    """(rule, grid step, place on the path), in the order in which steps are worth most.

    ``counts`` has, for each rule, how many bad and how many other documents each grid step is the first to
    reject. Successive steps of a rule are pooled until what they catch per document taken falls from pool to pool;
    the pools of all rules are merged by that ratio, which keeps each rule's own order. Pools that catch
    nothing are left out. Of steps that touch no document the first half shares the place before them and the
    others the place behind them, if that is of the same pool: cutoffs lie in the middle of gaps.
    """
    pools = []
    for number, (name, (bad, other)) in enumerate(counts.items()):
        own: list[list] = []  # steps with the gaps behind them, bad, other
        step = 0
        while step < len(bad):
            end = step + 1
            while end < len(bad) and not bad[end] and not other[end]:
                end += 1
            own.append([[(step, end)], bad[step], other[step]])
            while len(own) > 1 and _worth(own[-2], n_bad, n_other) <= _worth(own[-1], n_bad, n_other):
                last = own.pop()
                own[-1] = [x + y for x, y in zip(own[-1], last, strict=True)]
            step = end
        pools += [(-_worth(pool, n_bad, n_other), number, pool[0], name) for pool in own if pool[1]]
    path, at = [], 0
    for _, _, steps, name in sorted(pools):
        begin = steps[0][0]
        for step, end in steps:
            middle = step + 1 + (end - step - 1) // 2
            path += [(name, i, at) for i in range(begin, middle)]
            begin, at = middle, at + 1
    return path


def _worth(pool: list, n_bad: int, n_other: int) -> float:
    return pool[1] / max(1, n_bad) * (n_other + 1) / (pool[2] + 0.5)


def _paths(group: pd.DataFrame) -> pd.DataFrame:
    """From a stratum's histograms over the grids to its path."""
    counts, n_bad, n_other = {}, 0, 0
    for rule in RULES:
        own = group[group["rule"] == rule.name]
        n_bad, n_other = int(own["bad"].sum()), int(own["other"].sum())
        bad, other = (np.zeros(len(rule.grid) + 1, np.int64) for _ in range(2))
        np.add.at(bad, own["step"].to_numpy(), own["bad"].to_numpy())
        np.add.at(other, own["step"].to_numpy(), own["other"].to_numpy())
        counts[rule.name] = bad[:-1].tolist(), other[:-1].tolist()
    found = [(group["stratum"].iloc[0], *step) for step in draw_path(counts, n_bad, n_other)]
    return pd.DataFrame(found, columns=["stratum", "rule", "step", "at"])


def _picker(risk: float, error: float):
    """From a stratum's histogram over its path to the last step taken, if any."""

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        hit = group[group["at"].notna()]
        at = hit["at"].astype(int).to_numpy()
        good, bad = (np.zeros(at.max(initial=-1) + 1, np.int64) for _ in range(2))
        np.add.at(good, at, hit["good"].to_numpy())
        np.add.at(bad, at, hit["bad"].to_numpy())
        step = best_cutoff(list(np.cumsum(good)), list(np.cumsum(bad)), int(group["good"].sum()),
                           int(group["bad"].sum()), risk, error)
        found = [] if step is None else [(group["stratum"].iloc[0], step)]
        return pd.DataFrame(found, columns=["stratum", "upto"])

    return pick


def choose_cutoffs(
    measures: DataFrame, labels: DataFrame, max_false_reject: float = 0.02, error: float = 0.05
) -> DataFrame:
    """(stratum, rule, step, cutoff) for each rule that is of use in a stratum.

    ``measures`` has doc_id, stratum and MEASURES; ``labels`` has doc_id and quality (1: good).
    Counts cover every document that passes the base rules; what is grouped in one task is one histogram
    per stratum, of at most as many rows as the rules' grids have steps.
    """
    spark = measures.sparkSession
    root = workspace(spark, "quality")
    told = (labels.groupBy("doc_id").agg(F.min("quality").alias("label"))
            .filter("label IS NOT NULL AND doc_id IS NOT NULL"))
    passed = measures.filter(~base_failed())
    held = passed.join(told, "doc_id").groupBy(
        "doc_id", "stratum", (F.col("label") == 1).alias("good")
    ).agg(*[F.min(m).alias(m) for m in MEASURES])
    _by_rule(held, "doc_id", "stratum", "good").write.parquet(f"{root}/held")
    held = spark.read.parquet(f"{root}/held")
    other = _by_rule(passed.join(told, "doc_id", "left_anti"), "stratum")
    histogram = (
        other.select("*", F.lit(0).alias("b"), F.lit(1).alias("o"))
        .union(held.filter("NOT good").select("stratum", "rule", "step", F.lit(1), F.lit(0)))
        .groupBy("stratum", "rule", "step").agg(F.sum("b").alias("bad"), F.sum("o").alias("other"))
    )
    shape = "stratum string, rule string, step int, at int"
    histogram.groupBy("stratum").applyInPandas(_paths, shape).write.parquet(f"{root}/path")
    path = spark.read.parquet(f"{root}/path")

    strata = max(1, held.select("stratum").distinct().count())
    first = (held.join(path, ["stratum", "rule", "step"], "left")
             .groupBy("doc_id", "stratum", "good").agg(F.min("at").alias("at")))
    counts = first.groupBy("stratum", "at").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    ends = counts.groupBy("stratum").applyInPandas(_picker(max_false_reject, error / strata), "stratum string, upto int")
    grids = F.create_map(*[c for r in RULES for c in (F.lit(r.name), F.array(*[F.lit(x) for x in r.grid]))])
    (path.join(ends, "stratum").filter("at <= upto").groupBy("stratum", "rule").agg(F.max("step").alias("step"))
     .select("stratum", "rule", "step", F.get(grids[F.col("rule")], F.col("step")).alias("cutoff"))
     .write.parquet(f"{root}/cutoffs"))
    return spark.read.parquet(f"{root}/cutoffs")


def apply_rules(measures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measures`` with base_failed, n_rules_failed and kept."""
    wide = cutoffs.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in RULES
    ])
    failed = sum((
        F.coalesce(F.expr(f"{r.value} {'>' if r.over else '<'} cut_{r.name}"), F.lit(False)).cast("int")
        for r in RULES
    ), F.lit(0))
    base = F.col("base_failed")
    return (measures.join(wide, "stratum", "left").withColumn("base_failed", base_failed())
            .withColumn("n_rules_failed", F.when(base, F.lit(0)).otherwise(failed))
            .withColumn("kept", ~base & (F.col("n_rules_failed") == 0))
            .drop(*[f"cut_{r.name}" for r in RULES]))


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, stratum: Column | None = None,
    max_false_reject: float = 0.02, error: float = 0.05,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, tie (a hash of the text), stratum, MEASURES, base_failed,
    n_rules_failed, kept.

    The text is read once: measures are written to the shared folder and read back for the
    calibration and the verdicts.
    """
    spark = docs.sparkSession
    stratum = F.col("lang") if stratum is None else stratum
    path = f"{workspace(spark, 'quality')}/measures"
    named = docs.select("doc_id", F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"),
                        F.xxhash64("text").alias("tie"), "text")
    text_measures(named, "doc_id", "stratum", "tie").write.parquet(path)
    measures = spark.read.parquet(path)
    return apply_rules(measures, choose_cutoffs(measures, labels, max_false_reject, error))
