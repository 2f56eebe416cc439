"""WARC archives of web pages: written by Spark, read back, and assembled into captures.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record; the
first and the last name the second in ``WARC-Concurrent-To``. ``write_archives`` turns pages into
records and lets Spark's text writer put them, separated as the format asks, into gzip files of a
bounded number of captures. ``read_archives`` cuts the files back into records by their
``Content-Length``, so a payload may hold anything. ``assemble`` joins the three records through the
concurrent-to identifiers and returns one nested row per capture.

Of equal payloads of at least ``revisit_from`` bytes the row with the largest page id is the
response. Edge cases: a null html is an empty payload; a null page id orders before all others; a
null url gives a record without target; each row is a capture, rows equal in page id, url and html too: the
number of the row in its table is part of the record identifiers; empty tables give an empty archive and no captures.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTURES_PER_FILE = 1000
DATE = "2024-01-01T00:00:00Z"
_BREAK = "\r\n\r\n"
_NAMES = ("page_id", "url", "html", "row", "first_id", "first_url", "first_row", "is_revisit")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None, url: str | None, row: int, digest: str, kind: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}|{page_id}|{row}|{digest}|{url}").urn


def _record(fields: dict[str, str | None], block: str, size: int | None = None) -> str:
    """A record up to the two line breaks that end it."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    size = len(block.encode()) if size is None else size
    return f"WARC/1.1\r\n{head}Content-Length: {size}{_BREAK}{block}"


def _capture(page_id, url, html, row, first_id, first_url, first_row, is_revisit) -> list[str]:
    payload = html or ""
    raw = payload.encode()
    digest = sha1_base32(raw)
    target = None if url is None else "".join(f"%{ord(c):02X}" if c <= " " else c for c in url)
    kind = "revisit" if is_revisit else "response"
    # Whether a response or a revisit, the record has the id that others can refer to.
    own = _id(page_id, url, row, digest, "response")
    common = {"WARC-Target-URI": target, "WARC-Date": DATE}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}{_BREAK}"
    main = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{own}>", **common,
        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response",
    }
    about = f"pageId: {'' if page_id is None else page_id}\r\n"
    if is_revisit:
        main["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        main["WARC-Refers-To"] = f"<{_id(first_id, first_url, first_row, digest, 'response')}>"
        about += f"refersToPageId: {first_id}\r\n"
        block, size = http, len(http)
    else:
        block, size = http + payload, len(http) + len(raw)
    path = "/" if not target else "/" + target.split("://", 1)[-1].partition("/")[2]
    host = "" if not target else target.split("://", 1)[-1].partition("/")[0]
    return [
        _record({
            "WARC-Type": "request", "WARC-Record-ID": f"<{_id(page_id, url, row, digest, 'request')}>", **common,
            "WARC-Concurrent-To": f"<{own}>", "Content-Type": "application/http;msgtype=request",
        }, f"GET {path} HTTP/1.1\r\nHost: {host}{_BREAK}"),
        _record(main, block, size),
        _record({
            "WARC-Type": "metadata", "WARC-Record-ID": f"<{_id(page_id, url, row, digest, 'metadata')}>", **common,
            "WARC-Concurrent-To": f"<{own}>", "Content-Type": "application/warc-fields",
        }, about),
    ]


def with_first_copies(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """page_id, url, html, row number, and the copy that each row revisits, if any.

    ``pages`` is a table, so that a row has one number whenever it is read.

    The groups are aggregated before they are shuffled; they are joined by another key than they
    were grouped by, so that adaptive execution may split the rows of a payload that is everywhere.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"),
        F.octet_length(html).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"),
    )
    groups = (
        base.filter(F.col("size") >= revisit_from).groupBy("sha1", "size")
        .agg(F.count("*").alias("copies"), F.max(F.struct("page_id", "url", "row")).alias("first"))
        .filter("copies > 1")
        .select(F.concat_ws(":", "sha1", "size").alias("payload_key"), "first")
    )
    keyed = base.withColumn("payload_key", F.concat_ws(":", "sha1", "size")).drop("sha1", "size")
    first = F.col("first")
    return keyed.join(groups, "payload_key", "left").select(
        "page_id", "url", "html", "row", first["page_id"].alias("first_id"), first["url"].alias("first_url"),
        first["row"].alias("first_row"),
        (first.isNotNull() & ~F.col("page_id").eqNullSafe(first["page_id"])).alias("is_revisit"),
    )


def write_archives(
    pages: DataFrame, path: str, revisit_from: int = 0, captures_per_file: int = CAPTURES_PER_FILE
) -> None:
    """Write three records per page into gzip archives under ``path``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for row in rows for r in _capture(*row)], pa.string())], ["value"]
                )

    (with_first_copies(pages, revisit_from).select(*_NAMES).mapInArrow(records, "value string")
     .write.option("lineSep", _BREAK).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * captures_per_file).text(path))


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive's bytes."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:head].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        yield fields, content[head + 4 : head + 4 + size]
        at = head + 4 + size + 4


def _unzipped(content: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


RECORDS = (
    "record_id string, type string, concurrent_to string, target_uri string, date string, "
    "refers_to string, payload_digest string, payload_bytes bigint, page_id bigint, "
    "refers_to_page bigint, payload binary"
)


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _row(fields: dict[str, str], block: bytes, payload: bool) -> dict:
    kind = fields["warc-type"]
    row = {
        "record_id": fields["warc-record-id"], "type": kind, "concurrent_to": fields.get("warc-concurrent-to"),
        "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to"),
    }
    if kind == "metadata":
        about = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
        row |= {"page_id": _number(about.get("pageId")), "refers_to_page": _number(about.get("refersToPageId"))}
    elif kind in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            row |= {"payload_bytes": len(body), "payload_digest": sha1_base32(body)}
            if payload:
                row["payload"] = body
        else:  # a revisit has the head of the response only, which tells the payload's size
            sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            row |= {"payload_bytes": int(sizes[0]),
                    "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:")}
    return row


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``; without ``payload`` their bytes are only digested."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[x.split()[1]] for x in RECORDS.split(", ")]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            for content in batch.column(0):
                part = []
                for fields, block in parse(_unzipped(content.as_py())):
                    part.append(_row(fields, block, payload))
                    if len(part) == 512:
                        yield pa.RecordBatch.from_pylist(part, schema)
                        part = []
                yield pa.RecordBatch.from_pylist(part, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(rows, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, target_uri, request, response, metadata.

    A capture without a request or metadata record has null there. Records with one identifier are
    one record.
    """
    unique = records.dropDuplicates(["record_id"])
    fields = [c for c in records.columns if c != "concurrent_to"]

    def side(kind: str) -> DataFrame:
        return unique.filter(F.col("type") == kind).select(
            F.col("concurrent_to").alias("record_id"), F.struct(*fields).alias(kind)
        ).filter("record_id IS NOT NULL")

    main = unique.filter(F.col("type").isin("response", "revisit")).select(
        "record_id", "target_uri", F.struct(*fields).alias("response")
    )
    joined = main.join(side("request"), "record_id", "left").join(side("metadata"), "record_id", "left")
    return joined.select("record_id", "target_uri", "request", "response", "metadata")
