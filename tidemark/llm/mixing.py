"""Mixing sources to target weights: budgets down a tree, then a seeded token-prefix of each leaf.

The tree's levels are columns (domain, language, source). ``budgets`` hands the token budget down: the
children of a node share its budget by weight; what a child cannot take (its supply times
``max_epochs``) goes to its siblings by their weights, and to the relatives of an ancestor only when
all children of a node are full. A leaf's budget is spent in epochs: whole ones, then the prefix of
one more, in the order of a hash of seed, epoch and document.

The prefix of a leaf is found without sorting it: its hash range is cut into buckets of a bounded
number of rows and those into parts. Bucket totals tell which bucket holds the end, the totals of its parts
which part does, and only the keys of that part are ordered, with one total per key. All totals are combined
before they are shuffled, so a hot leaf sends as many rows as a small one. The result is one cutoff per leaf, with which a scan of the documents is filtered. Only
leaf totals reach the driver, one row per leaf of the configured tree; more than ``MAX_LEAVES`` raise.

Edge cases: a null level is the name ``""``; a null or empty text has no tokens and comes along in each
whole epoch and in the prefix where its hash lies; rows equal in document, levels and text stand
together; a leaf that no weight names has weight 1 among its siblings; empty tables give no rows; the
documents' other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.session import workspace

MAX_LEAVES = 200_000
BROADCAST_LEAVES = 20_000  # a plan of at most so many rows is broadcast, a larger one is joined
BUCKET_ROWS = 20_000
PARTS = 256  # of a bucket
Path = tuple[str, ...]


def share(budget: float, weights: Sequence[float], room: Sequence[float]) -> list[float]:
    """Split a budget by weight; what one cannot take goes to the others by weight."""
    given = [0.0] * len(weights)
    open_ = [i for i, w in enumerate(weights) if w > 0]
    left = budget
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= room[i] - given[i]]
        if not full:
            for i in open_:
                given[i] += left * weights[i] / total
            break
        # Those that fill up take their room; the rest is dealt again among the others.
        for i in full:
            left -= room[i] - given[i]
            given[i] = room[i]
        open_ = [i for i in open_ if i not in set(full)]
    return given


def budgets(supply: Mapping[Path, int], weights: Mapping[Path, float], total: float, max_epochs: int) -> dict[Path, int]:
    """The token budget of each leaf."""
    children: dict[Path, set[Path]] = {}
    room: dict[Path, float] = {}
    for leaf, tokens in supply.items():
        for depth in range(len(leaf)):
            children.setdefault(leaf[:depth], set()).add(leaf[: depth + 1])
        for depth in range(len(leaf) + 1):
            room[leaf[:depth]] = room.get(leaf[:depth], 0) + tokens * max_epochs
    given: dict[Path, int] = {}
    waiting = [((), min(float(total), room.get((), 0.0)))]
    while waiting:
        node, budget = waiting.pop()
        if node in supply and node not in children:
            given[node] = int(budget + 1e-6)
            continue
        below = sorted(children.get(node, ()))
        parts = share(budget, [weights.get(c, 1.0) for c in below], [room[c] for c in below])
        waiting.extend(zip(below, parts, strict=True))
    return given


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, off in tx.sliced(batches):
        _, _, owner = tx.words(data, off)
        tokens = pa.array(np.bincount(owner, minlength=len(off) - 1).astype(np.int64))
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], [*names, "tokens"])


def _order_key(seed: int, epoch: Column, doc_id: Column, tie: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, doc_id, tie)


def _part(key: Column, parts: Column) -> Column:
    """Parts in the order of the key, of equal ranges."""
    place = F.shiftrightunsigned(key.bitwiseXOR(F.lit(-(2**63))), 1).cast("double") / F.lit(2.0**63)
    return F.least((place * parts).cast("long"), parts - 1)


def mix(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[Path, float], budget_share: float = 1.0,
    max_epochs: int = 2, seed: int = 1,
) -> DataFrame:
    """``docs`` with mix_path and mix_epoch (from 0), which replace such columns; one row per copy taken.

    The budget is ``budget_share`` of all words of ``docs``.
    """
    spark = docs.sparkSession
    root = workspace(spark, "mixing")
    names = list(levels)
    path = F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in levels.values()])
    text = F.col("text").cast("string")
    tie = F.xxhash64(text)
    lean = docs.select(F.col("doc_id"), path.alias("mix_path"), tie.alias("tie"), text.alias("text"))
    kind = lean.schema["doc_id"].dataType.simpleString()
    lean.mapInArrow(
        _count_tokens, f"doc_id {kind}, mix_path array<string>, tie bigint, tokens bigint"
    ).write.parquet(f"{root}/sizes")
    sizes = spark.read.parquet(f"{root}/sizes")

    totals = sizes.groupBy("mix_path").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    leaves = totals.limit(MAX_LEAVES + 1).collect()
    if len(leaves) > MAX_LEAVES:
        raise ValueError(f"the mixing tree has more than {MAX_LEAVES} leaves; use coarser {names}")
    supply = {tuple(r["mix_path"]): int(r["tokens"]) for r in leaves}
    given = budgets(supply, weights, budget_share * sum(supply.values()), max_epochs)
    rows = []
    for r in leaves:
        leaf = tuple(r["mix_path"])
        whole, rest = divmod(given[leaf], supply[leaf]) if supply[leaf] else (0, 0)
        rows.append((list(leaf), whole, rest, max(1, -(-int(r["rows"]) // BUCKET_ROWS))))
    plan = spark.createDataFrame(rows, "mix_path array<string>, whole int, rest long, buckets int")

    def small(df: DataFrame) -> DataFrame:
        """A row per leaf; its size is known here, so a leaf with most rows need not meet in one task."""
        return F.broadcast(df) if len(rows) <= BROADCAST_LEAVES else df

    def placed(df: DataFrame) -> DataFrame:
        """With each row's place in its leaf's next epoch."""
        key = _order_key(seed, F.col("whole"), F.col("doc_id"), F.col("tie"))
        return df.withColumn("key", key).withColumn("part", _part(F.col("key"), F.col("buckets") * F.lit(PARTS)))

    def end(of: DataFrame, unit: str) -> DataFrame:
        """The unit of each leaf in which its budget ends, and what is spent before it."""
        upto = F.col("before") + F.sum("tokens").over(Window.partitionBy("mix_path").orderBy(unit))
        return (
            of.groupBy("mix_path", unit, "rest", "before").agg(F.sum("tokens").alias("tokens")).withColumn("upto", upto)
            .filter("upto > rest AND upto - tokens <= rest")
            .select("mix_path", F.col(unit).alias(f"cut_{unit}"), (F.col("upto") - F.col("tokens")).alias("spent"))
        )

    def inside(ends: DataFrame, unit: str) -> DataFrame:
        """The rows in the units found."""
        return (
            within.drop("before").join(small(ends.withColumn(unit, F.col(f"cut_{unit}"))), ["mix_path", unit])
            .withColumnRenamed("spent", "before")
        )

    within = (
        placed(sizes.join(small(plan.filter("rest > 0")), "mix_path"))
        .withColumn("bucket", F.expr(f"part DIV {PARTS}")).withColumn("before", F.lit(0).cast("long"))
    )
    part_ends = end(inside(end(within, "bucket"), "bucket"), "part")
    in_order = Window.partitionBy("mix_path").orderBy("key")
    cuts = (
        inside(part_ends, "part").groupBy("mix_path", "cut_part", "rest", "before", "key")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("upto", F.col("before") + F.sum("tokens").over(in_order))
        .groupBy("mix_path", "cut_part")
        .agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))).alias("cut_key"))
    )
    plan.join(cuts, "mix_path", "left").write.parquet(f"{root}/plan")
    rows_with_plan = docs.select(
        F.struct(*docs.columns).alias("doc"), "doc_id", path.alias("mix_path"), tie.alias("tie")
    ).join(small(spark.read.parquet(f"{root}/plan")), "mix_path")
    taken = (F.col("part") < F.col("cut_part")) | (
        (F.col("part") == F.col("cut_part")) & (F.col("key") <= F.col("cut_key"))
    )
    copies = F.col("whole") + F.coalesce(taken, F.lit(False)).cast("int")
    return (
        placed(rows_with_plan).withColumn("copies", copies).filter("copies > 0")
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("mix_path", "mix_epoch")],
                "mix_path", "mix_epoch")
    )
