"""Near-duplicate classes from weighted MinHash signatures by hashed darts.

Shingles of five words are weighted by their count. Each unit of weight of a shingle is a column of
the plane (weight x rank) at which darts are thrown, as many per area as a Poisson variable drawn
from a hash of shingle, unit and rank band; a dart's rank and coordinate are hashed as well, so equal
regions get equal darts in every document. Ranks are looked at up to about ``t / weight`` with ``t``
enough to fill all coordinates, so long documents cost no more darts than short ones. A signature keeps
the earliest dart of each coordinate; two signatures agree in a coordinate with the probability of
the documents' weighted Jaccard similarity.

Exact copies are folded first. Bands of a signature are joined by their hash: every document of a band is
compared with the band's first one, exactly on their shingles; classes are the connected components
of the pairs found. Documents of bands that still hold several classes are compared once more, all
across, in blocks of bounded size, so that no link between documents of a band is lost; a pair of blocks
emits what connects classes, no pairs. With 30 bands of 5 a pair of similarity 0.8 shares a band
with probability 0.99999.

Texts are told apart by 128 bits of hash over their words, never by doc_id, so rows of one doc_id may be of several
classes. Of each class one text is chosen: that of the smallest doc_id, and of several such the one with the smallest hash.

Edge cases: a text without words is a class of its own; one of fewer than five words is one
shingle; a null doc_id is no class id: its class is that of the other rows of its class, else null, and it is chosen
only where all are null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.components import components
from tidemark.session import workspace

WIDTH = 5
ROWS, BANDS = 5, 30
COORDINATES = ROWS * BANDS
LEAST = 0.8
BLOCK, BLOCK_BYTES = 256, 1 << 20  # documents of a block, and bytes of their packed texts
COLUMNS = 4096
_DARTS = COORDINATES * (math.log(COORDINATES) + 2)
_LOWEST = 6  # the first band of ranks is [0, 2**-6), each further one doubles the range
_U = np.uint64


def _poisson_table(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts."""
    n = int(area + 12 * math.sqrt(area) + 12)
    logs = np.array([i * math.log(area) - area - math.lgamma(i + 1) for i in range(n)])
    return np.cumsum(np.exp(logs))


_tables: dict[int, np.ndarray] = {}


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def elements(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of each unit of shingle weight, and the 128-bit key of each text's words."""
    starts, ends, owner = tx.words(data, off)
    n = len(off) - 1
    h = tx.range_hash(tx.prefix_sums(data, 11), starts, ends)
    count = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    valid = np.flatnonzero(tx.windows_inside(owner, WIDTH))
    shingle, doc = tx.window_hash(h, WIDTH)[valid], owner[valid]
    short = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(short):
        whole = [tx.window_hash(h[first[i] : first[i + 1]], int(count[i]))[0] for i in short]
        shingle, doc = np.concatenate([shingle, np.array(whole, _U)]), np.concatenate([doc, short])
    key = tx.mix(shingle + doc.astype(_U) * _U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    key, shingle, doc = key[order], shingle[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    unit = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    # The words in order, twice hashed: equal for exact copies up to white space.
    place = tx.mix((np.arange(len(h)) - first[owner]).astype(_U) + _U(1))
    keys = np.zeros((n, 2), _U)
    for i, salt in enumerate((_U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F))):
        total = np.zeros(len(h) + 1, _U)
        np.cumsum(tx.mix((h ^ salt) * (place | _U(1)) + place), dtype=_U, out=total[1:])
        keys[:, i] = total[first[1:]] - total[first[:-1]]
    return tx.join_hash(shingle, unit.astype(_U)), doc, keys


def signatures(element: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """n x COORDINATES: rank (as the bits of a float) and hash of the earliest dart of each coordinate."""
    flat = np.full(n * COORDINATES, np.iinfo(np.uint64).max, _U)
    weight = np.bincount(doc, minlength=n)
    reach = np.ceil(np.log2(_DARTS / np.maximum(weight, 1))).astype(int) + _LOWEST
    reach = np.maximum(reach, 0)[doc]
    for band in range(int(reach.max(initial=-1)) + 1):
        low, high = (0.0 if band == 0 else 2.0 ** (band - 1 - _LOWEST)), 2.0 ** (band - _LOWEST)
        table = _tables.setdefault(band, _poisson_table(high - low))
        at = np.flatnonzero(reach >= band)
        seed = tx.mix(element[at] ^ _U(tx.scalar_mix(1000 + band)))
        drawn = _uniform(seed)
        some = drawn >= table[0]
        at, seed = at[some], seed[some]
        number = np.minimum(np.searchsorted(table, drawn[some], "right"), len(table))
        owner = np.repeat(doc[at], number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        dart = tx.mix(np.repeat(seed, number) + (nth.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
        rank = (low + (high - low) * _uniform(dart)).astype(np.float32).view(np.uint32).astype(_U)
        other = tx.mix(dart ^ _U(0xD1B54A32D192ED03))
        coordinate = (other >> _U(33)) % _U(COORDINATES)
        packed = (rank << _U(32)) | (other & _U(0xFFFFFFFF))
        np.minimum.at(flat, owner * COORDINATES + coordinate.astype(np.int64), packed)
    return flat.reshape(n, COORDINATES)


def _units(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return np.sort(elements(data, np.array([0, len(data)], np.int64))[0])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, off in tx.sliced(batches):
        n = len(off) - 1
        element, doc, keys = elements(data, off)
        tie = batch.column(2)
        sig = signatures(element, doc, n)
        bands = sig.reshape(n, BANDS, ROWS)
        h = np.broadcast_to(tx.mix(np.arange(1, BANDS + 1, dtype=_U)), (n, BANDS)).copy()
        for i in range(ROWS):
            h = tx.join_hash(h, bands[:, :, i])
        weight = np.bincount(doc, minlength=n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), tie, pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(weight.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(h.view(np.int64).ravel()))],
            ["doc_id", "tie", "text_key", "weight", "bands"],
        )


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch, data, off in tx.sliced(batches):
        raw = data.tobytes()
        texts = [pack(raw[off[i] : off[i + 1]]) for i in range(len(off) - 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(texts, pa.binary())], ["doc_id", "tie", "packed"]
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose texts are similar enough."""
    unpack = zstandard.ZstdDecompressor().decompress
    last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, _U))
    for batch in batches:
        a, b = [], []
        for i in range(batch.num_rows):
            x, y, one, two = (batch.column(c)[i].as_py() for c in range(4))
            if two != last[0]:
                last = (two, _units(unpack(two)))
            mine, theirs = _units(unpack(one)), last[1]
            shared = int(tx.among(mine, theirs).sum())
            if shared >= LEAST * (len(mine) + len(theirs) - shared) - 1e-9:
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, path: str) -> DataFrame:
    """node and packed text of the nodes in the pairs (a, b), each from the row that stands for it.

    Joined by a shuffle at any size: how many documents are wanted grows with the input.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b"))).distinct()
    rows = nodes.join(wanted.hint("merge"), "node", "left_semi").select(
        "node", F.col("pick.doc_id").alias("its_doc"), F.col("pick.tie").alias("its_tie")
    )
    found = docs.join(rows.select("its_tie").distinct().hint("merge"), F.col("tie") == F.col("its_tie"), "left_semi").select(
        "doc_id", "text", "tie"
    ).mapInArrow(_compress, "doc_id bigint, tie bigint, packed binary")
    same = F.col("doc_id").eqNullSafe(F.col("its_doc")) & (F.col("tie") == F.col("its_tie"))
    found.join(rows.hint("merge"), same).groupBy("node").agg(F.any_value("packed").alias("packed")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) with similarity LEAST or more, computed on the texts."""
    joined = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("one")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("packed").alias("two")), "b")
    )
    return joined.select("a", "b", "one", "two").mapInArrow(_verify, "a binary, b binary")


def _linked(key, rows):
    """Links between classes in a pair of blocks: pairs of labels, enough to connect what is similar.

    The shared weight of all pairs is one product of document-by-unit matrices, taken in slices of
    columns; a unit in one document only is shared by none.
    """
    left = np.flatnonzero(rows.column("left").to_numpy(zero_copy_only=False))
    right = np.flatnonzero(rows.column("right").to_numpy(zero_copy_only=False))
    names, label = np.unique(np.array(rows.column("label").to_pylist(), object), return_inverse=True)
    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(t.as_py()) for t in rows.column("packed")]
    off = np.cumsum([0, *map(len, texts)])
    element, doc, _ = elements(np.frombuffer(b"".join(texts), np.uint8), off)
    weight = np.bincount(doc, minlength=len(texts))
    order = np.argsort(element, kind="stable")
    element, doc = element[order], doc[order]
    new = np.ones(len(element), bool)
    new[1:] = element[1:] != element[:-1]
    several = ~new
    several[:-1] |= ~new[1:]
    doc, column = doc[several], np.cumsum(new[several]) - 1
    shared = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        has = np.zeros((len(texts), COLUMNS), np.float32)
        has[doc[a:b], column[a:b] - begin] = 1
        shared += has[left] @ has[right].T
    union = weight[left][:, None] + weight[right][None, :] - shared
    near = (shared >= LEAST * union - 1e-4) & (label[left][:, None] != label[right][None, :])
    i, j = np.nonzero(near)
    pairs = np.unique(np.sort(np.stack([label[left[i]], label[right[j]]], axis=1), axis=1), axis=0)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for x, y in pairs.tolist():
        low, high = sorted((find(x), find(y)))
        if low != high:
            root[high] = low
            out.append((high, low))
    return pa.table({"a": pa.array([names[x] for x, _ in out], pa.binary()), "b": pa.array([names[y] for _, y in out], pa.binary())})


def _rest(shared: DataFrame, labels: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """Links (a, b) between labels, from bands whose documents are of several classes so far.

    The documents of such bands are gathered by the band's smallest label, so that a group that shares many
    bands is compared once, and dealt to pairs of blocks of bounded size.
    """
    own = shared.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = own.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    several = mixed.select(F.bitwise_not("band").alias("key"), "low")
    (own.withColumn("key", F.bitwise_not("band")).join(several, "key").select("low", "node", "label").distinct()
     .join(texts.select("node", F.octet_length("packed").alias("size")), "node")
     .groupBy("low", "node", "label").agg(F.max("size").alias("size")).write.parquet(path))
    many = shared.sparkSession.read.parquet(path)
    blocks = many.groupBy("low").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        many.join(blocks.withColumnRenamed("low", "group"), F.col("low") == F.col("group"))
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("low", "node", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")
        .select("low", "i", "j", "node", "label",
                (F.col("block") == F.col("i")).alias("left"), (F.col("block") == F.col("j")).alias("right"))
    )
    return dealt.join(texts, "node").groupBy("low", "i", "j").applyInArrow(_linked, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), n_copies of the row's text, text_key, tie and chosen.

    ``tie`` is xxhash64 of the text; ``chosen`` marks the rows of a class that hold its chosen text under its doc_id.
    """
    spark = docs.sparkSession
    root = workspace(spark, "darts")
    text = F.col("text").cast("string")
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    lean.mapInArrow(
        _sketch, "doc_id bigint, tie bigint, text_key binary, weight bigint, bands array<bigint>"
    ).write.parquet(f"{root}/sketches")
    sketches = spark.read.parquet(f"{root}/sketches")
    # One node per text, and the row that stands for it. Copies of a text have one signature.
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")).alias("pick")
    sketches.filter("weight > 0").groupBy(F.col("text_key").alias("node")).agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), pick
    ).write.parquet(f"{root}/firsts")
    firsts = spark.read.parquet(f"{root}/firsts")
    same = (
        F.col("doc_id").eqNullSafe(F.col("its_doc")) & (F.col("tie") == F.col("its_tie")) & (F.col("text_key") == F.col("node"))
    )
    stand = firsts.select("node", F.col("pick.doc_id").alias("its_doc"), F.col("pick.tie").alias("its_tie"))
    sketches.filter("weight > 0").join(stand, same).select("node", "bands").dropDuplicates(["node"]).write.parquet(
        f"{root}/nodes"
    )
    nodes = spark.read.parquet(f"{root}/nodes")

    bands = nodes.select("node", F.explode("bands").alias("band"))
    # Grouped by one form of the key and joined by another: rows of a frequent band may be split.
    leaders = (
        bands.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        .filter("leader <> last").select(F.bitwise_not("band").alias("key"), "leader")
    )
    bands.withColumn("key", F.bitwise_not("band")).join(leaders, "key").select("band", "node", "leader").write.parquet(
        f"{root}/shared"
    )
    shared = spark.read.parquet(f"{root}/shared")
    stars = shared.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    stars.write.parquet(f"{root}/stars")
    stars = spark.read.parquet(f"{root}/stars")
    texts = _texts(lean, firsts, stars, f"{root}/texts")
    _similar(stars, texts).write.parquet(f"{root}/links")
    labels = components(spark.read.parquet(f"{root}/links"))

    _rest(shared.select("band", "node"), labels, texts, f"{root}/mixed").write.parquet(f"{root}/more")
    more = spark.read.parquet(f"{root}/more")
    if more.limit(1).count():
        joined = components(more).select(F.col("node").alias("label"), F.col("label").alias("lower"))
        # Labels without a document of their own in ``labels`` are documents that had no link yet.
        alone = joined.join(labels, joined["label"] == labels["node"], "left_anti").select(
            F.col("label").alias("node"), F.col("lower").alias("label")
        )
        labels = labels.join(joined, "label", "left").select(
            "node", F.coalesce("lower", "label").alias("label")
        ).union(alone)
    # Only texts that are linked to others need more than their own smallest row.
    joined = firsts.join(labels, "node").select("node", "label", "doc_id", "pick")
    joined.groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("class_id"), F.min("pick").alias("best")).write.parquet(
        f"{root}/classes"
    )
    classes = spark.read.parquet(f"{root}/classes")
    joined.join(classes, F.col("label") == F.col("of")).select(F.col("node").alias("linked"), "class_id", "best").write.parquet(
        f"{root}/linked"
    )
    linked = spark.read.parquet(f"{root}/linked")
    firsts.join(linked, F.col("node") == F.col("linked"), "left").select(
        "node", "n_copies", F.when(F.col("linked").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("best", "pick").alias("best"),
    ).write.parquet(f"{root}/named")
    named = spark.read.parquet(f"{root}/named")
    empty = F.col("weight") == 0
    best = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tie") == F.col("best.tie"))
    return (
        sketches.select("doc_id", "tie", "text_key", "weight").join(named, F.col("text_key") == F.col("node"), "left")
        .select(
            "doc_id", F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.hex("text_key").alias("text_key"), "tie",
            (empty | F.coalesce(best, F.lit(False))).alias("chosen"),
        )
    )
