"""Repeated runs of lines, found on suffixes of line-ID sequences by prefix doubling; SQL functions only.

A document is the sequence of the IDs of its lines with a character other than white space. The rank
of a suffix at depth ``w`` stands for its first ``w`` lines: suffixes of equal rank are an interval of
the suffix array whose common prefix has at least ``w`` lines. As a rank serves the smallest position
(document, line) of its interval, so ranks need no global order, equal prefixes are counted by an
aggregation that combines before it shuffles, and the first copy of a run is known by its rank being its own
position. A doubling joins the rank at ``p`` with the one at ``p + w``; suffixes whose rank is theirs
alone are dropped between the levels, for no longer prefix of theirs is repeated.

A line is deleted if it lies in a run of ``min_lines`` lines that also starts earlier, or is itself at
least ``min_chars`` long and occurs earlier. Overlapping runs unite to the maximal ones. All is
judged on the input. Blank lines inside a deleted run go with it, others stay.

Edge cases: a null or empty text has no lines; rows of one doc_id are told apart by a hash of their
text, rows equal in both are one document for the counts and each get its result; a null doc_id
orders before all others; ties cannot occur, as positions are unique; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import workspace

MIN_LINES = 2
MIN_CHARS = 50
_SPACES = "\t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (the whole row), doc_id, run_tie, run_text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*docs.columns).alias("doc"), "doc_id", F.xxhash64(text).alias("run_tie"), text.alias("run_text")
    )


def _positions(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: at (document, n-th such line), line, last, size, h1, h2."""
    keyed = _keyed(docs)
    numbered = F.transform(
        _lines(F.col("run_text")), lambda x, i: F.struct(i.alias("line"), x.alias("text"))
    )
    full = F.filter(numbered, lambda s: F.trim(F.translate(s["text"], _SPACES, "")) != "")
    return keyed.select("doc_id", "run_tie", F.posexplode(full).alias("n", "s")).select(
        F.struct("doc_id", F.col("run_tie").alias("tie"), "n").alias("at"),
        F.col("s.line").alias("line"), F.length("s.text").alias("size"),
        F.xxhash64("s.text").alias("h1"), F.xxhash64(F.lit(1), F.col("s.text")).alias("h2"),
    )


def _ranked(suffixes: DataFrame, *prefix: str) -> DataFrame:
    """The suffixes whose ``prefix`` columns occur at several positions, with rank: the smallest of them.

    They are grouped by the columns and joined by a struct of them, so that adaptive execution may
    split the rows of a line that is everywhere.
    """
    classes = (
        suffixes.groupBy(*prefix).agg(F.min("at").alias("rank"), F.max("at").alias("last_at"))
        .filter("rank <> last_at").select(F.struct(*prefix).alias("prefix"), "rank")
    )
    return suffixes.withColumn("prefix", F.struct(*prefix)).join(classes, "prefix").drop("prefix", *prefix)


def _extended(ranked: DataFrame, by: int) -> DataFrame:
    """With ``next``: the rank ``by`` lines further in the same document, and the line it ends at."""
    ahead = Window.partitionBy("at.doc_id", "at.tie").orderBy("at.n").rangeBetween(by, by)
    return ranked.withColumns({
        "next": F.first("rank").over(ahead), "last": F.first("last").over(ahead),
    }).filter("next IS NOT NULL")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, run_tie, removed): the numbers of the deleted lines of each document that has any."""
    root = workspace(docs.sparkSession, "lines")
    spark = docs.sparkSession
    _ranked(_positions(docs), "h1", "h2").withColumn("last", F.col("line")).write.parquet(f"{root}/depth1")
    ranked = spark.read.parquet(f"{root}/depth1")
    span = F.sequence("line", "last")
    later = F.col("rank") < F.col("at")
    gone = ranked.filter(later & (F.col("size") >= min_chars)).select("at", span.alias("span"))
    depth = 1
    while depth < min_lines:
        by = min(depth, min_lines - depth)  # the last step may overlap
        depth += by
        _double(ranked, by).write.parquet(f"{root}/depth{depth}")
        ranked = spark.read.parquet(f"{root}/depth{depth}")
    gone = gone.union(ranked.filter(later).select("at", span.alias("span")))
    return gone.select(
        F.col("at.doc_id").alias("doc_id"), F.col("at.tie").alias("run_tie"), F.explode("span").alias("line")
    ).groupBy("doc_id", "run_tie").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _double(ranked: DataFrame, by: int) -> DataFrame:
    longer = _extended(ranked, by).withColumnRenamed("rank", "here")
    return _ranked(longer, "here", "next").select("at", "line", "last", "size", "rank")


def drop_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with kept_text, n_lines and n_removed, which replace columns of these names; one row per row."""
    removed = repeated_lines(docs, min_lines, min_chars).withColumnsRenamed({"doc_id": "id", "run_tie": "tie"})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("run_tie") == F.col("tie"))
    joined = _keyed(docs).join(removed, same, "left").withColumn("run_lines", _lines(F.col("run_text")))
    # The numbers that stay, then the lines they name: linear in the lines, unlike a look-up per line.
    stay = F.array_except(F.sequence(F.lit(0), F.size("run_lines") - 1), F.col("removed"))
    kept = F.transform(stay, lambda i: F.element_at(F.col("run_lines"), i + 1))
    added = {
        "kept_text": F.when(F.col("removed").isNull(), F.col("run_text")).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.size("run_lines").cast("long"),
        "n_removed": F.coalesce(F.size("removed"), F.lit(0)).cast("long"),
    }
    return joined.select(
        *[F.col("doc")[c].alias(c) for c in docs.columns if c not in added],
        *[c.alias(name) for name, c in added.items()],
    )
