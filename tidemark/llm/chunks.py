"""Texts in chunks of a few megabytes, and questions about hashes between all chunks.

A chunk is one row: a few megabytes of whole texts in the order of their doc_id, those of one doc_id by a hash of the
text; it is named by its content and its place in the partition. Chunks are written
once to the shared folder, so they are the same in every later pass and after any lost executor.
A pass sends each chunk's entries (distinct within the chunk) to hash buckets, one packed *cell* per
chunk and bucket; what is everywhere thus counts once a chunk. A bucket answers with a bit or so per
entry, in the cell's own order, and the answers are joined to the chunks by their name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20  # of text for each bucket
_NULL = np.iinfo(np.int64).min
CHUNK = "chunk string, n_bytes bigint, doc_ids array<bigint>, text_keys array<bigint>, sizes array<bigint>, packed binary"
CELL = "bucket int, chunk string, entries binary, docs binary, extra binary"
ANSWER = "chunk string, bucket int, answer binary"


@dataclass
class Chunk:
    name: str
    doc_ids: pa.Array  # as given
    order_ids: np.ndarray  # null: the smallest
    data: np.ndarray
    off: np.ndarray
    answers: list[dict[int, bytes]]
    text_keys: np.ndarray | None = None  # hashes of the texts

    def doc(self, at: np.ndarray) -> np.ndarray:
        """Text number of each byte position."""
        return np.searchsorted(self.off, at, "right") - 1


def pack(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the chunks of ``doc_id, text`` rows; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, number = zstandard.ZstdCompressor(level=3).compress, 0
        for batch, data, off in tx.sliced(batches, limit=chunk_bytes):
            ids = batch.column(0).cast(pa.int64())
            order_ids = pc.fill_null(ids, int(_NULL)).to_numpy(zero_copy_only=False)
            raw, at = data.tobytes(), memoryview(data)
            keys = np.array([xxhash.xxh3_64_intdigest(at[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)],
                            np.uint64)
            sizes, order = np.diff(off), np.lexsort((keys, order_ids))
            if (np.diff(order) < 0).any():
                raw = b"".join([raw[off[i] : off[i + 1]] for i in order])
            name = f"{hashlib.md5(raw).hexdigest()}-{TaskContext.get().partitionId()}-{number}"
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(raw)]),
                 pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                 pa.array([keys[order].view(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([sizes[order].tolist()], pa.list_(pa.int64())), pa.array([squeeze(raw)], pa.binary())],
                ["chunk", "n_bytes", "doc_ids", "text_keys", "sizes", "packed"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked.mapInArrow(run, CHUNK).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def bucket_count(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets in proportion to the text, so that a bucket's share is bounded."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(64, -(-total // bucket_bytes))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {c: batch.column(k)[i] for k, c in enumerate(names)}
            sizes = row["sizes"].values.to_numpy(zero_copy_only=False)
            ids = row["doc_ids"].values
            answers = [
                {a["bucket"]: a["answer"] for a in row[c].as_py() or []} for c in names if c.startswith("answers")
            ]
            raw = expand(row["packed"].as_py(), max_output_size=max(1, int(sizes.sum())))
            yield Chunk(
                row["chunk"].as_py(), ids, pc.fill_null(ids, int(_NULL)).to_numpy(zero_copy_only=False),
                np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), answers,
                row["text_keys"].values.to_numpy(zero_copy_only=False).view(np.uint64),
            )


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of 64-bit hashes, by their high bits: sorted hashes have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cells(chunk: str, bucket: np.ndarray, buckets: int, rows: Callable[[np.ndarray], tuple]) -> pa.RecordBatch:
    """One row per bucket that has entries; ``rows(at)`` packs the entries numbered ``at``."""
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets))
    full = np.flatnonzero(np.diff(ends, prepend=0))
    packed = [rows(order[(ends[b - 1] if b else 0) : ends[b]]) for b in full]
    columns = list(zip(*packed, strict=True)) if packed else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([chunk] * len(full), pa.string()),
         *[pa.array(list(c), pa.binary()) for c in columns]],
        ["bucket", "chunk", "entries", "docs", "extra"],
    )


def read_answers(answers: dict[int, bytes], bucket: np.ndarray, buckets: int, size: np.ndarray | None = None):
    """The bits of each entry, in the entries' order; ``size``: bits per entry, 1 if none is given.

    With sizes the bits of entry i are at ``[start[i], start[i] + size[i])`` of the array returned.
    """
    order = np.argsort(bucket, kind="stable")
    size = np.ones(len(bucket), np.int64) if size is None else size
    per_bucket = np.bincount(bucket.astype(np.int64), weights=size, minlength=buckets).astype(np.int64)
    parts = []
    for b in np.flatnonzero(per_bucket):
        bits = np.unpackbits(np.frombuffer(answers[int(b)], np.uint8), count=int(per_bucket[b]))
        parts.append(bits.astype(bool))
    bits = np.concatenate(parts) if parts else np.zeros(0, bool)
    start = np.zeros(len(bucket), np.int64)
    ends = np.cumsum(size[order])
    start[order] = ends - size[order]
    return bits, start


def with_answers(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Chunks with one array of answers per question."""
    for i, a in enumerate(answers):
        gathered = a.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias(f"answers{i}"))
        chunks = chunks.join(gathered, "chunk", "left")
    return chunks


def _ask(cells_: DataFrame, reply: Callable, path: str) -> DataFrame:
    spark: SparkSession = cells_.sparkSession
    cells_.groupBy("bucket").applyInArrow(reply, ANSWER).write.parquet(path)
    return spark.read.parquet(path)


def ask(cells_: DataFrame, decide: Callable[[list[dict]], list[np.ndarray]], path: str) -> DataFrame:
    """Answers of all buckets: ``decide`` gets a bucket's cells and returns the bits for each."""

    def reply(table):
        rows = table.select(["chunk", "entries", "docs", "extra"]).to_pylist()
        bits = decide(rows)
        return pa.table({
            "chunk": pa.array([r["chunk"] for r in rows], pa.string()),
            "bucket": table.column("bucket").combine_chunks().cast(pa.int32()),
            "answer": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
        })

    return _ask(cells_, reply, path)
