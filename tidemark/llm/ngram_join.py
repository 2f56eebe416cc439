"""Groups of documents linked by the Jaccard similarity of their word n-grams, by blocked sparse matrix products.

Documents are the rows of an incidence matrix, distinct n-grams its columns; the product of the matrix with its
transpose holds the overlap of each pair. Two documents of sizes ``a`` and ``b`` can only be linked if

* the smaller is at least ``LEAST`` per cent of the larger, and they overlap in ``LEAST / (100 + LEAST) * (a + b)`` columns;
* they share one of the first ``n - ceil(LEAST * n / 100) + 1`` columns of both, in any order common to all documents. The order is
  by how many documents hold a column, rare ones first, so documents that are mostly their own drop out.

So the counts of all columns are taken first (each once per chunk, see ``chunks``). Documents that share one of their
first columns form a group, named by its smallest document, split by classes of size and into blocks of bounded size.
A block is multiplied with itself and with the first block of its class and of the next; what is linked then is one
component. Other pairs of blocks of a group are multiplied only where the group is still of several components, and not
both of its largest one. A product adds up slices of columns, drops pairs below the bounds and emits what connects documents,
not all pairs. Equal sets are one document. No link between different sets is lost.

Edge cases: a null text has no words; fewer words than ``WIDTH`` are one n-gram; an empty set is linked with nothing, not
even its equals; rows of one doc_id are separate documents; a null doc_id names no component, it takes the
smallest doc_id of its component or null. Long texts are hashed in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks as ck
from tidemark.llm import text as tx
from tidemark.llm.components import components
from tidemark.session import workspace

WIDTH, LEAST = 4, 85
BLOCK, BLOCK_GRAMS = 512, 1 << 20  # documents of a block, and their n-grams together
COLUMNS = 4096  # of a slice of the product
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS_BITS = 4


def gram_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each distinct n-gram of each text, by text and hash."""
    h, count = tx.word_hashes(_LOWER[data], off, 23)
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(count)), count)
    inside = tx.windows_inside(owner, WIDTH)
    gram, doc = tx.window_hash(h, WIDTH)[inside], owner[: len(inside)][inside]
    short = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(short):
        whole = [tx.window_hash(h[first[i] : first[i + 1]], int(count[i]))[0] for i in short]
        gram, doc = np.concatenate([gram, np.array(whole, _U)]), np.concatenate([doc, short])
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    return gram[new], doc[new]


def _distinct(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of a chunk, the place of each entry among them, and how many texts have them."""
    return np.unique(gram, return_inverse=True, return_counts=True)


def _gram_cells(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for chunk in ck.unpacked(batches):
        values, _, times = _distinct(gram_sets(chunk.data, chunk.off)[0])
        short, times = (values & _U(0xFFFFFFFF)).astype(np.uint32), times.astype(np.uint32)
        yield ck.cells(chunk.name, ck.bucket_of(values, buckets), buckets,
                       lambda at: (short[at].tobytes(), None, squeeze(times[at].tobytes())))


def _frequency_classes(rows: list[dict]) -> list[np.ndarray]:
    """Four bits for each n-gram of a bucket's cells: 0 if one text has it, else the rounded binary logarithm of how many."""
    expand = zstandard.ZstdDecompressor().decompress
    sizes = [len(r["entries"]) // 4 for r in rows]
    values = np.concatenate([np.frombuffer(r["entries"], np.uint32) for r in rows])
    times = np.concatenate([
        np.frombuffer(expand(r["extra"], max_output_size=max(1, 4 * n)), np.uint32)
        for r, n in zip(rows, sizes, strict=True)
    ])
    order = np.argsort(values, kind="stable")
    begins = np.concatenate([[True], values[order[1:]] != values[order[:-1]]])
    total = np.add.reduceat(times[order].astype(np.float64), np.flatnonzero(begins))
    rank = np.minimum(np.ceil(np.log2(total)), 2**_CLASS_BITS - 1).astype(np.uint8)
    of = np.zeros(len(values), np.uint8)
    of[order] = rank[np.cumsum(begins) - 1]
    bits = np.unpackbits(of[:, None], axis=1)[:, -_CLASS_BITS:].astype(bool)
    return [x.reshape(-1) for x in np.split(bits, np.cumsum(sizes)[:-1])]


def _sets(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each document's size and key; of those that may have a partner also the first columns and, once a chunk, the set."""
    for chunk in ck.unpacked(batches):
        n = len(chunk.off) - 1
        gram, doc = gram_sets(chunk.data, chunk.off)
        size = np.bincount(doc, minlength=n)
        ends = np.cumsum(size)
        keys = np.zeros((n, 2), _U)
        for i, salt in enumerate((_U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F))):
            total = np.zeros(len(gram) + 1, _U)
            np.cumsum(tx.mix(gram ^ salt), dtype=_U, out=total[1:])
            keys[:, i] = total[ends] - total[ends - size]
        key = [k.tobytes() for k in keys]
        values, place, _ = _distinct(gram)
        four = np.full(len(values), _CLASS_BITS, np.int64)
        bits, start = ck.read_answers(chunk.answers[0], ck.bucket_of(values, buckets), buckets, four)
        rank = np.zeros(len(values), np.uint8)
        for i in range(_CLASS_BITS if len(values) else 0):
            rank = rank * 2 + bits[start + i]
        rank = rank[place]
        order = np.lexsort((gram, rank, doc))
        nth = np.arange(len(gram)) - np.repeat(ends - size, size)  # place in its document's order
        first = size - (LEAST * size + 99) // 100 + 1
        picked = order[(nth < first[doc]) & (rank[order] > 0)]
        some = np.bincount(doc[picked], minlength=n)
        columns, at, seen = gram[picked].view(np.int64), np.cumsum(some), set()
        listed, sets = [], []
        for i in range(n):
            listed.append(columns[at[i] - some[i] : at[i]] if some[i] else None)
            fresh = some[i] and key[i] not in seen
            sets.append(gram[ends[i] - size[i] : ends[i]].tobytes() if fresh else None)
            if fresh:
                seen.add(key[i])
        yield pa.RecordBatch.from_arrays(
            [chunk.doc_ids, pa.array(key, pa.binary()), pa.array(size), pa.array(listed, pa.list_(pa.int64())),
             pa.array(sets, pa.large_binary()).cast(pa.binary())],
            ["doc_id", "key", "n_shingles", "columns", "grams"],
        )


def _packed(table: pa.Table) -> pa.Table:
    """The documents of a block as one row."""
    return pa.table({
        **{c: table.column(c)[:1] for c in ("low", "size_class", "part")},
        "keys": pa.array([table.column("key").to_pylist()], pa.list_(pa.binary())),
        "sizes": pa.array([table.column("n_shingles").to_pylist()], pa.list_(pa.int64())),
        "grams": pa.array([b"".join(table.column("grams").to_pylist())], pa.binary()),
    })


def overlaps(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many columns each pair of rows of two blocks (sizes, columns row by row) shares."""
    (a_sizes, a_grams), (b_sizes, b_grams) = left, right
    shared = np.zeros((len(a_sizes), len(b_sizes)))
    a_values, a_column = np.unique(a_grams, return_inverse=True)
    both = np.intersect1d(a_values, b_grams)
    if not len(both):
        return shared

    def entries(sizes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, grams), len(both) - 1)
        known = both[at] == grams
        row, column = np.repeat(np.arange(len(sizes)), sizes)[known], at[known]
        order = np.argsort(column, kind="stable")
        return row[order], column[order]

    rows = [entries(a_sizes, a_grams), entries(b_sizes, b_grams)]
    for begin in range(0, len(both), COLUMNS):
        parts = []
        for (row, column), n in zip(rows, shared.shape, strict=True):
            i, j = np.searchsorted(column, [begin, begin + COLUMNS])
            part = np.zeros((n, min(COLUMNS, len(both) - begin)), np.float32)
            part[row[i:j], column[i:j] - begin] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    return shared


def _linked(left: tuple, right: tuple, same: bool) -> list[tuple[int, int]]:
    """Pairs of row numbers (of the right block behind the left one) that connect all linked rows."""
    a, b = left[0], right[0]
    near = 100 * np.minimum.outer(a, b) >= LEAST * np.maximum.outer(a, b)
    if not near.any():
        return []
    enough = (100 + LEAST) * overlaps(left, right) >= LEAST * np.add.outer(a, b)
    i, j = np.nonzero(near & enough)
    j = j if same else j + len(a)
    root = np.arange(len(a) + (0 if same else len(b)))
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return [(k, int(r)) for k, r in enumerate(root) if k != r]


def _products(batches: Iterator[pa.RecordBatch], same: bool) -> Iterator[pa.RecordBatch]:
    """Links of blocks with themselves (keys, sizes, grams) or of two blocks (the same of the other one behind)."""
    for batch in batches:
        a, b = [], []
        for row in zip(*(c for c in batch.columns), strict=True):
            blocks = [
                (keys.as_py(), (sizes.values.to_numpy(), np.frombuffer(grams.as_buffer(), _U)))
                for keys, sizes, grams in (row[:3], row[0 if same else 3 :][:3])
            ]
            keys = blocks[0][0] + ([] if same else blocks[1][0])
            for x, y in _linked(blocks[0][1], blocks[1][1], same):
                a.append(keys[x])
                b.append(keys[y])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


_PAYLOAD = ["keys", "sizes", "grams"]


def _multiplied(pairs: DataFrame) -> DataFrame:
    columns = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("x", "y") for c in _PAYLOAD]
    return pairs.select(*columns).mapInArrow(lambda b: _products(b, False), "a binary, b binary")


def _blocks(sets: DataFrame, root: str) -> DataFrame:
    """Blocks of the documents that share a first column with the group's smallest."""
    spark = sets.sparkSession
    sets.filter("columns IS NOT NULL").select("key", "n_shingles", F.explode("columns").alias("gram")).distinct().write.parquet(
        f"{root}/columns"
    )
    entries = spark.read.parquet(f"{root}/columns")
    # Joined by another form of the key than it is grouped by, so that a frequent column may be split.
    lows = (
        entries.groupBy("gram").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high")
        .select(F.bitwise_not("gram").alias("gram_key"), "low")
    )
    size_class = F.floor(F.log("n_shingles") / -math.log((LEAST - 0.1) / 100)).cast("int").alias("size_class")
    entries.withColumn("gram_key", F.bitwise_not("gram")).join(lows, "gram_key").select(
        "low", "key", "n_shingles", size_class
    ).distinct().write.parquet(f"{root}/members")
    members = spark.read.parquet(f"{root}/members")
    members.groupBy(F.col("low").alias("of"), F.col("size_class").alias("of_class")).agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_GRAMS)).cast("int").alias("parts")
    ).write.parquet(f"{root}/parts")
    parts = spark.read.parquet(f"{root}/parts")
    sets.filter("grams IS NOT NULL").join(members.select("key").distinct().hint("merge"), "key", "left_semi").groupBy("key").agg(
        F.any_value("grams").alias("grams")
    ).write.parquet(f"{root}/grams")
    grams = spark.read.parquet(f"{root}/grams")
    placed = members.join(parts, (F.col("low") == F.col("of")) & (F.col("size_class") == F.col("of_class"))).select(
        "low", "size_class", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key", "n_shingles"
    )
    placed.join(grams.hint("merge"), "key").groupBy("low", "size_class", "part").applyInArrow(
        _packed, "low binary, size_class int, part int, keys array<binary>, sizes array<bigint>, grams binary"
    ).write.parquet(f"{root}/blocks")
    return spark.read.parquet(f"{root}/blocks")


def _first_links(blocks: DataFrame) -> DataFrame:
    """Links within blocks, and of each block with the first of its class; first blocks with those of the next class."""
    own = blocks.select(*_PAYLOAD).mapInArrow(lambda b: _products(b, True), "a binary, b binary")
    firsts = blocks.filter("part = 0").alias("x")
    later = blocks.filter("part > 0").alias("y")
    others = blocks.filter("part = 0").alias("y")
    in_class = firsts.join(later, (F.col("x.low") == F.col("y.low")) & (F.col("x.size_class") == F.col("y.size_class")))
    beside = firsts.join(others, (F.col("x.low") == F.col("y.low")) & (F.col("x.size_class") + 1 == F.col("y.size_class")))
    return own.union(_multiplied(in_class)).union(_multiplied(beside))


def _other_links(blocks: DataFrame, labels: DataFrame, root: str) -> DataFrame:
    """Links of the other pairs of blocks, where a group is still of several components."""
    spark = blocks.sparkSession
    wide = blocks.filter("part > 0").select("low").distinct()
    rows = blocks.join(wide, "low", "left_semi").select("low", "size_class", "part", F.explode("keys").alias("node"))
    # Documents without a link are their own component.
    labelled = rows.join(labels, "node", "left").select("low", "size_class", "part", F.coalesce("label", "node").alias("label"))
    labelled.groupBy("low", "size_class", "part", "label").agg(F.count("*").alias("n")).write.parquet(f"{root}/block_labels")
    counts = spark.read.parquet(f"{root}/block_labels")
    largest = (
        counts.groupBy("low", "label").agg(F.sum("n").alias("n")).groupBy("low")
        .agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count("*").alias("labels"))
        .filter("labels > 1").select(F.col("low").alias("of"), "largest")
    )
    marked = counts.join(largest, F.col("low") == F.col("of")).groupBy("low", "size_class", "part").agg(
        F.bool_and(F.col("label") == F.col("largest")).alias("plain")
    )
    marked.write.parquet(f"{root}/marked")
    marked = spark.read.parquet(f"{root}/marked")
    held = blocks.join(marked, ["low", "size_class", "part"])
    x, y = held.filter("NOT plain").alias("x"), held.alias("y")
    place = [F.struct(f"{s}.size_class", f"{s}.part") for s in ("x", "y")]
    once = F.col("y.plain") | (place[0] < place[1])
    new = ~((F.least("x.part", "y.part") == 0) & (
        (F.col("x.size_class") == F.col("y.size_class")) | (F.greatest("x.part", "y.part") == 0)
    ))
    near = F.abs(F.col("x.size_class") - F.col("y.size_class")) <= 1
    return _multiplied(x.join(y, (F.col("x.low") == F.col("y.low")) & near & once & new))


def linked_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``doc_id, text``: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and set_key."""
    spark = docs.sparkSession
    root = workspace(spark, "ngrams")
    chunks = ck.pack(docs, f"{root}/chunks")
    buckets = ck.bucket_count(chunks)
    classes = ck.ask(chunks.mapInArrow(lambda b: _gram_cells(b, buckets), ck.CELL), _frequency_classes, f"{root}/classes")
    ck.with_answers(chunks, classes).mapInArrow(
        lambda b: _sets(b, buckets), "doc_id bigint, key binary, n_shingles bigint, columns array<bigint>, grams binary"
    ).write.parquet(f"{root}/sets")
    sets = spark.read.parquet(f"{root}/sets")

    blocks = _blocks(sets, root)
    _first_links(blocks).distinct().write.parquet(f"{root}/links")
    links = spark.read.parquet(f"{root}/links")
    labels = components(links)
    if blocks.filter("part > 0").limit(1).count():
        _other_links(blocks, labels, root).distinct().write.parquet(f"{root}/more")
        more = spark.read.parquet(f"{root}/more")
        if more.limit(1).count():
            labels = components(links.union(more))

    # Rows of a set, then sets of a component: only what is not alone needs a name.
    lean = sets.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    lean.join(labels, F.col("key") == F.col("node"), "left").filter("rows > 1 OR label IS NOT NULL").select(
        "key", "doc_id", F.coalesce("label", "key").alias("label")
    ).write.parquet(f"{root}/named")
    named = spark.read.parquet(f"{root}/named")
    named.groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("component_id")).write.parquet(f"{root}/lowest")
    lowest = spark.read.parquet(f"{root}/lowest")
    named.join(lowest, F.col("label") == F.col("of")).select(F.col("key").alias("set_key"), "component_id").write.parquet(
        f"{root}/components"
    )
    found = spark.read.parquet(f"{root}/components")
    return sets.join(found, F.col("key") == F.col("set_key"), "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("set_key").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id")).alias("component_id"),
        F.hex("key").alias("set_key"),
    )
