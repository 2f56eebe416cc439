"""Top-k and WARC transactions against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import random

from pyspark.sql import functions as F

from tidemark.llm import topk, warc


def test_top_k(spark):
    rng = random.Random(4)
    base = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(300)]
    rows = [(i, base[7] if i % 3 == 0 else base[i]) for i in range(300)]
    rows += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1001, [math.inf] * 6), (1100, [1.0, 2.0]),
             (1002, [0.5, 0.25]), (None, base[1]), (1150, [float("nan")] * 6), (1003, base[5]), (1003, base[5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = {}
    for r in topk.top_k(table.repartition(4), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = {}
    for i, q in usable:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable
                            if j != i and len(v) == len(q))[:5]
            want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert {k: sorted(v) for k, v in got.items()} == want
    assert len(want[1100]) == 1


def test_top_k_of_few_and_large_values(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(table, F.col("vec_id") % 50 == 0).count() == 0
    rows = [(0, [3e5, -2e5]), (1, [3e5, 1.0]), (2, [-3e5, 7e4])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(table, F.col("vec_id") == 0).orderBy("rank").collect()]
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = sorted(((sum(a * b for a, b in zip(ints[0], ints[j], strict=True)), j) for j in (1, 2)), reverse=True)
    assert got == [(j, s) for s, j in want]


def test_a_query_with_broken_rows_keeps_its_good_vector(spark):
    good = [1.0, 0.5]
    broken = [None, [None, 9.0], [-math.inf, 0.0], [float("nan"), 0.0], [0.0, None]]
    rows = [(50 * i, v) for i, v in enumerate(broken)] + [(50 * i, good) for i in range(len(broken))]
    rows += [(250, [None, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    for kind in ("double", "float"):
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = {}
        for r in topk.top_k(table, F.col("vec_id") % 50 == 0, k=1).collect():
            got[r.query_id] = (r.vec_id, r.score)
        assert got == {50 * i: (1, 256 * 256 + 128 * 256) for i in range(len(broken))}


def test_a_large_component_is_no_error_while_scores_fit(spark):
    rows = [(i, [float(i + 1)] * 128) for i in range(4)]
    rows[2][1][5] = 2e6
    rows += [(4, [1e9] * 2), (5, [3.0, -1.0]), (6, [2.0, 7.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(table, F.lit(True)).collect()}
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    assert got == {(i, j): sum(a * b for a, b in zip(ints[i], ints[j], strict=True))
                   for i in ints for j in ints if i != j and len(ints[i]) == len(ints[j])}


def test_blocks_are_bounded_by_bytes():
    import pyarrow as pa

    table = pa.RecordBatch.from_arrays(
        [pa.array(range(3000)), pa.array([[0.5] * (4096 if i % 3 else 8) for i in range(3000)])], ["vec_id", "embedding"])
    blocks = [b for b in topk._blocks(iter([table]), 256.0, topk.CANDIDATES)]
    assert sum(len(b.column(2)[0].as_py()) // 8 for b in blocks) == 3000
    assert max(len(b.column(3)[0].as_py()) for b in blocks) <= 2 * topk.BLOCK_BYTES


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_transactions(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    rows = [(1, "http://a/x", "<p>é</p>"), (2, "http://a/y?q=1", "<p>é</p>"), (9, None, "<p>é</p>"),
            (3, "http://b/", None), (4, "http://b/\r\nX: y", ""), (5, "http://c/1", tricky), (6, "http://c/1", tricky + " "),
            (None, "http://n/", "lone"), (7, "http://d/", "x" * 300_000), (7, "http://d/", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("type", F.lit(1))
    path = str(tmp_path / "archives")
    warc.write_archives(pages.repartition(3), path, captures_per_file=2)
    got = {r.metadata.page_id: r for r in warc.assemble(warc.read_archives(spark, path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for page_id, _, html in rows:
        r = got[page_id]
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        assert r.response.payload_bytes == len((html or "").encode())
        assert r.response.payload_digest == _digest(html)
        assert r.request.type == "request" and r.request.target_uri == r.response.target_uri
        if first is None or page_id == first:
            assert r.response.type == "response" and r.metadata.refers_to_page is None
            assert bytes(r.response.payload).decode() == (html or "")
        else:
            assert r.response.type == "revisit" and r.metadata.refers_to_page == first
            assert r.response.refers_to == got[first].record_id


def test_repeated_rows_are_captures(spark, tmp_path):
    rows = [(1, "u", "<p>"), (1, "u", "<p>"), (1, "v", "<p>"), (2, "u", "<p>"), (2, "u", "<p>"), (3, "u", "x"), (3, "u", "x"), (3, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "pages"))
    path = str(tmp_path / "copies")
    warc.write_archives(spark.read.parquet(str(tmp_path / "pages")), path)
    got = warc.assemble(warc.read_archives(spark, path)).collect()
    assert sorted((r.metadata.page_id, r.response.type) for r in got) == [
        *[(1, "revisit")] * 3, *[(2, "response")] * 2, *[(3, "response")] * 3]
    assert all(r.request.record_id for r in got) and len({r.record_id for r in got}) == len(rows)
    named = {r.record_id for r in got if r.metadata.page_id == 2}
    assert len({r.response.refers_to for r in got if r.metadata.page_id == 1} - named) == 0


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.assemble(warc.read_archives(spark, path)).count() == 0


def test_revisits_from_a_size(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")],
                                  "page_id long, url string, html string")
    path = str(tmp_path / "some")
    warc.write_archives(pages, path, revisit_from=3)
    got = {r.metadata.page_id: r.response.type for r in warc.assemble(warc.read_archives(spark, path)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
