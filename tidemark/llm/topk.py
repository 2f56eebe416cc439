"""Exact top-k by inner product: global score histograms, refined until each k-th score is known.

Vectors become integers (``floor(scale * x)``). Candidates and queries are packed into blocks and
every query block meets every candidate block, so each pair is scored, by one matrix product per pair
of blocks. A round counts, for each query, the scores in equal bins of its current range; the summed
counts tell the bin of the k-th highest score, which is the next round's range. When the range is one
integer, the k-th score is known, and a last pass emits only what reaches it. Ties at the k-th score
go to the smaller id; a block emits at most as many of them as a query still needs, so a vector that
occurs a million times stays cheap. Nothing is dropped: the rest of the ties cannot be in the result.

Products are exact in double precision while they stay below 2**53, which is checked per pair of
blocks; beyond, Python integers are used, and a score (of two different rows) that is no 64-bit integer raises an error.
A first pass finds each query's lowest and highest score, which is its first range. Blocks are bounded by bytes; a query block
holds as many queries as candidates can be dealt to cheaply, and is scored in strips.

Edge cases: vectors that are null, or hold a null or non-finite component, and rows without an id
take no part; a query meets vectors of its own length only; rows that repeat a query's id are
not its candidates, and the query is the smallest of their usable vectors; with fewer than k candidates all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import workspace

BINS = 512
CANDIDATES = 8192
QUERIES = 16384
STRIP = 256  # queries scored at a time
BLOCK_BYTES = 16 << 20  # of components
SPREAD = 16  # tasks among which a query block's work is dealt
_BLOCK = "dim int, top double, ids binary, data binary"


def integers(values: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * values.astype(np.float64))


def _blocks(batches: Iterator[pa.RecordBatch], scale: float, rows: int) -> Iterator[pa.RecordBatch]:
    """Packed blocks of up to ``rows`` usable vectors of one length each."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    held = 0

    def packed(dim: int) -> pa.RecordBatch:
        parts = waiting.pop(dim)
        ids, data = (np.concatenate(x) for x in zip(*parts, strict=True))
        top = float(np.abs(data).max(initial=0))
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([top]), pa.array([ids.tobytes()], pa.binary()),
             pa.array([data.tobytes()], pa.binary())],
            ["dim", "top", "ids", "data"],
        )

    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        keep = pc.and_(pc.is_valid(ids), pc.is_valid(vectors))
        ids, vectors = ids.filter(keep), vectors.filter(keep)
        ids = ids.cast(pa.int64()).to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().cast(pa.float64())
        flat = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        for dim in np.unique(sizes):
            most = max(1, min(rows, BLOCK_BYTES // (8 * max(1, int(dim)))))
            rows_at = np.flatnonzero(sizes == dim)
            data = flat[begin[rows_at][:, None] + np.arange(dim)] if dim else np.zeros((len(rows_at), 0))
            finite = np.isfinite(data).all(axis=1)
            some_ids, data = ids[rows_at][finite], integers(data[finite], scale)
            for at in range(0, len(some_ids), most):
                part = waiting.setdefault(int(dim), [])
                part.append((some_ids[at : at + most], data[at : at + most]))
                held += len(part[-1][0]) * 8 * max(1, int(dim))
                if sum(len(x) for x, _ in part) >= most:
                    held -= sum(len(x) for x, _ in part) * 8 * max(1, int(dim))
                    yield packed(int(dim))
            # Lengths that wait together are no more than one block either.
            while held > 2 * BLOCK_BYTES:
                largest = max(waiting, key=lambda d: d * sum(len(x) for x, _ in waiting[d]))
                held -= sum(len(x) for x, _ in waiting[largest]) * 8 * max(1, largest)
                yield packed(largest)
    for dim in list(waiting):
        yield packed(dim)


def _matrix(raw: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(n, dim)


def _scores(q: np.ndarray, c: np.ndarray, tops: float, other: np.ndarray) -> np.ndarray:
    """Integer inner products, exact where ``other`` is true."""
    if q.shape[1] * tops < 2**53:
        return (q @ c.T).astype(np.int64)
    exact = np.where(other, np.frompyfunc(int, 1, 1)(q) @ np.frompyfunc(int, 1, 1)(c).T, 0)
    if exact.size and max(abs(exact.max()), abs(exact.min())) >= 2**62:
        raise ArithmeticError("a score is no 64-bit integer")
    return exact.astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Query block number, number of its queries, strip of them, their ids and state, candidate ids, scores, and
    which pairs are of two rows; for each strip of each pair of blocks."""
    for batch in batches:
        for row in range(batch.num_rows):
            x = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
            q_ids, c_ids = np.frombuffer(x["q_ids"], np.int64), np.frombuffer(x["ids"], np.int64)
            queries, candidates = _matrix(x["q_data"], x["dim"], len(q_ids)), _matrix(x["data"], x["dim"], len(c_ids))
            state = {k: np.frombuffer(x[k], np.int64) for k in ("low", "span", "need") if k in x}
            for at in range(0, len(q_ids), STRIP):
                strip = slice(at, at + STRIP)
                other = q_ids[strip, None] != c_ids[None, :]
                scores = _scores(queries[strip], candidates, x["q_top"] * x["top"], other)
                yield x["block"], len(q_ids), strip, q_ids[strip], {k: v[strip] for k, v in state.items()}, c_ids, scores, other


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, low, high): the lowest and highest score of each query among the task's candidates."""
    most = np.iinfo(np.int64).max
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for block, n, strip, _, _, _, scores, other in _pairs(batches):
        low, high = found.setdefault(block, (np.full(n, most), np.full(n, -most)))
        if scores.shape[1]:
            low[strip] = np.minimum(low[strip], np.where(other, scores, most).min(axis=1))
            high[strip] = np.maximum(high[strip], np.where(other, scores, -most).max(axis=1))
    for block, (low, high) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary())],
            ["block", "low", "high"],
        )


def _count(batches: Iterator[pa.RecordBatch], bins: int) -> Iterator[pa.RecordBatch]:
    """(block, counts): how many candidates of the task fall into each bin of each query's range."""
    sums: dict[int, np.ndarray] = {}
    for block, n, strip, _, state, _, scores, other in _pairs(batches):
        counts = sums.setdefault(block, np.zeros((n, bins), np.int64))[strip]
        offset = scores - state["low"][:, None]
        span = state["span"][:, None]
        step = -(-span // bins)
        inside = (offset >= 0) & (offset < span) & other
        query, _ = np.nonzero(inside)
        at = query * bins + (offset // step)[inside]
        counts += np.bincount(at, minlength=counts.size).reshape(counts.shape)
    for block, counts in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([counts.tobytes()], pa.binary())], ["block", "counts"]
        )


def narrowed(low: np.ndarray, span: np.ndarray, need: np.ndarray, counts: np.ndarray):
    """The bin that holds each query's k-th score, as a new range, and how many it must still give.

    A query with fewer candidates than it needs keeps its lowest bin: it takes all there are.
    """
    bins = counts.shape[1]
    width = -(-span // bins)
    from_top = np.cumsum(counts[:, ::-1], axis=1)
    enough = from_top >= need[:, None]
    at = np.where(enough.any(axis=1), enough.argmax(axis=1), bins - 1)
    above = np.where(at > 0, np.take_along_axis(from_top, np.maximum(at - 1, 0)[:, None], 1)[:, 0], 0)
    return low + (bins - 1 - at) * width, width, need - above


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates above the k-th score, and the ties with the smallest ids that may be needed."""
    for _, _, _, q_ids, state, c_ids, scores, other in _pairs(batches):
        order = np.argsort(c_ids, kind="stable")
        c_ids, scores, other = c_ids[order], scores[:, order], other[:, order]
        tie = (scores == state["low"][:, None]) & other
        tie &= np.cumsum(tie, axis=1) <= state["need"][:, None]
        query, at = np.nonzero(((scores > state["low"][:, None]) & other) | tie)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[query]), pa.array(c_ids[at]), pa.array(scores[query, at])],
            ["query_id", "vec_id", "score"],
        )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's ``k`` best rows of ``vectors``."""
    spark = vectors.sparkSession
    root = workspace(spark, "topk")
    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("is_query"))
    size = CANDIDATES
    picked.select("vec_id", "embedding").mapInArrow(lambda b: _blocks(b, scale, size), _BLOCK).write.parquet(
        f"{root}/candidates"
    )
    # A null or non-finite component makes a vector unusable, and may sort below the good ones.
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    asked = picked.filter("is_query").filter(usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    tasks = max(1, math.ceil(asked.count() / QUERIES))
    (asked.repartition(tasks).mapInArrow(lambda b: _blocks(b, scale, QUERIES), _BLOCK)
     .select(F.monotonically_increasing_id().alias("block"), F.spark_partition_id().alias("route"), "dim",
             F.col("top").alias("q_top"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
     .write.parquet(f"{root}/queries"))
    candidates, queries = spark.read.parquet(f"{root}/candidates"), spark.read.parquet(f"{root}/queries")
    # Each candidate block goes once to every query block of its length: a stated query set, in blocks.
    met = candidates.withColumn("deal", F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).cast("int")).withColumn(
        "route", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    )

    def pairs(state: DataFrame | None) -> DataFrame:
        known = queries if state is None else queries.join(state, "block")
        dealt = known.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        return met.join(dealt, ["route", "deal", "dim"]).drop("route", "deal")

    pairs(None).mapInArrow(_edges, "block bigint, low binary, high binary").write.parquet(f"{root}/edges")
    edges = spark.read.parquet(f"{root}/edges")

    def begin(key, rows):
        """The first range of each query; one without candidates has an empty one at 0."""
        low, high = (np.stack([np.frombuffer(x.as_py(), np.int64) for x in rows.column(c)]) for c in ("low", "high"))
        low, high = low.min(axis=0), high.max(axis=0)
        low, high = np.where(low <= high, low, 0), np.where(low <= high, high, 0)
        return pa.Table.from_batches([_state(key[0].as_py(), low, high - low + 1, np.full(len(low), k))])

    kind = "block bigint, low binary, span binary, need binary"
    edges.groupBy("block").applyInArrow(begin, kind).write.parquet(f"{root}/begin")
    state = spark.read.parquet(f"{root}/begin")

    def widest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            spans = [int(np.frombuffer(x.as_py(), np.int64).max(initial=1)) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(spans, pa.int64())], ["span"])

    span = state.select("span").mapInArrow(widest, "span bigint").agg(F.max("span")).first()[0] or 1
    rounds = 0
    while span > BINS**rounds:
        rounds += 1
    for i in range(rounds):
        counted = pairs(state).mapInArrow(lambda b: _count(b, BINS), "block bigint, counts binary")

        def update(key, rows):
            x = {c: rows.column(c)[0].as_py() for c in ("low", "span", "need")}
            low, span, need = (np.frombuffer(x[c], np.int64) for c in ("low", "span", "need"))
            counts = sum(np.frombuffer(c.as_py(), np.int64) for c in rows.column("counts") if c.is_valid)
            counts = np.broadcast_to(counts, len(low) * BINS).reshape(len(low), BINS)
            return pa.Table.from_batches([_state(key[0].as_py(), *narrowed(low, span, need, counts))])

        state.join(counted, "block", "left").groupBy("block").applyInArrow(update, kind).write.parquet(
            f"{root}/round{i}"
        )
        state = spark.read.parquet(f"{root}/round{i}")
    found = pairs(state).mapInArrow(_emit, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _state(block: int, low: np.ndarray, span: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    packed = [pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (low, span, need)]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *packed], ["block", "low", "span", "need"])
