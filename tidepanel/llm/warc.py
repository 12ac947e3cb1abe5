"""WARC archives with revisit records.

``write`` makes one record per page in archives of about ``ARCHIVE_BYTES``. Headers
(page, payload digest, payload size) are shuffled by digest; the smallest page_id of a
digest is the original, the others become revisit records joined to it. The join is an
ordinary sort-merge join of narrow rows, so adaptive execution splits a hot digest. Only
then are payloads placed: responses carry theirs, revisits carry fresh headers that name
the original: type, date, a record id of its own, the page, the page and record it refers to.
Archives are written through Spark's own writer, on any file system that Spark reaches.

Each record is a gzip member of its own. Spark's text writer ends every value with a separator
that can't be empty; it is a zero byte here, the last byte of every member whose contents are
shorter than 16 MiB (the top byte of their length), which is left out of the value. A longer
record is a run of such members. ``read`` decompresses as it goes and parses record by record
by Content-Length; a payload may hold any bytes, line breaks included.

Defined results: a null html is an empty payload; of repeated rows (same page_id, same
payload) one is the response, if any is, and each has a record id of its own; a null page_id
sorts last and may refer to or be an original only if no other page has the payload; very long
payloads are written and digested whole; an empty table makes no archive; extra columns take
no part.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows, arrow_schema, cut, shared_path

#: Payload bytes that an archive file holds on average.
ARCHIVE_BYTES = 16_000_000
NULL_ID = -(2**63)
#: The alphabets of radix 32 digits and of RFC 4648 base32.
RADIX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_id string, page_id string, record_type string, target_uri string, date string, payload_bytes bigint, payload_digest string, refers_to string, refers_to_record string, payload binary"
#: Contents of a gzip member are shorter than 16 MiB.
MEMBER = 1 << 23


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1 of a payload, in SQL functions: 160 bits are four groups of eight digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), RADIX32, BASE32)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, digest, n`` -> one row per distinct page and payload, with ``original``."""
    each = headers.select("page_id", "digest", "n").distinct()
    first = headers.where(F.col("n") >= min_bytes).groupBy(F.col("digest").alias("d"), F.col("n").alias("m")).agg(F.min("page_id").alias("original"), F.lit(True).alias("grouped"))
    return each.join(first, F.expr("digest = d and n = m"), "left").select("page_id", "digest", "n", "original", F.coalesce("grouped", F.lit(False)).alias("grouped"))


def records(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages with resolved types: ``page_id, uri, payload, digest, n, refers_to, record_type``, dealt into archives."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    # a key without nulls, so that the window and the join below share one exchange of payloads
    key = F.coalesce(pages["page_id"].cast("bigint"), F.lit(NULL_ID))
    whole = pages.select(pages["page_id"].alias("page_id"), key.alias("key"), pages["url"].cast("string").alias("uri"), payload.alias("payload"))
    headed = whole.withColumns({"n": F.octet_length("payload").cast("bigint"), "digest": payload_digest(F.col("payload"))})
    headers = cut(headed.select("page_id", "n", "digest"), "headers")
    found = cut(resolve(headers, min_bytes), "resolved").select(F.coalesce(F.col("page_id").cast("bigint"), F.lit(NULL_ID)).alias("pkey"), F.col("digest").alias("pdigest"), "original", "grouped")
    files = int((headers.agg(F.sum("n")).first()[0] or 0) // archive_bytes + 1)
    once = Window.partitionBy("key", "digest").orderBy(F.col("uri").asc_nulls_last())
    dealt = headed.repartition(max(files, 2), "key", "digest").withColumn("nth", F.row_number().over(once))
    joined = dealt.join(found, F.expr("key = pkey and digest = pdigest"))
    response = ~F.col("grouped") | (F.col("page_id").eqNullSafe(F.col("original")) & (F.col("nth") == 1))
    own, other = record_id("key", "digest", "nth"), record_id("okey", "digest", F.lit(1))  # a response in a group is the first of its page's rows
    joined = joined.withColumn("okey", F.coalesce(F.col("original").cast("bigint"), F.lit(NULL_ID))).withColumn("response", response)
    return joined.select(
        "page_id", "uri", "payload", "digest", "n", own.alias("id"), F.when(~F.col("response"), F.col("original")).alias("refers_to"),
        F.when(~F.col("response"), other).alias("refers_to_id"), F.when(F.col("response"), "response").otherwise("revisit").alias("record_type"),
    )


def record_id(key: str, digest: str, nth: str | Column) -> Column:
    """The URN of a page's nth row with a payload: a UUID from their hash."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(digest), (F.col(nth) if isinstance(nth, str) else nth).cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def _record(date: str) -> Column:
    """One WARC record."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    clean = F.regexp_replace(F.coalesce("uri", F.lit("")), r"[\r\n]", "")
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    urn = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Page-ID", page("page_id")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", urn("refers_to_id")), line("X-Refers-To-Page-ID", page("refers_to")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit("\r\n\r\n"),
    )


def members(record: bytes) -> bytes:
    """A record as gzip members, without the last byte, which is 0."""
    out = b"".join(gzip.compress(record[at : at + MEMBER], 6, mtime=0) for at in range(0, len(record), MEMBER))
    return out[:-1]


def write(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> None:
    """Write deduplicated archives of ``page_id, url, html`` under ``path``; ``date`` (UTC, as in 2024-01-31T00:00:00Z) is now if not given."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = records(pages, min_bytes, archive_bytes).select(_record(date).cast("binary").alias("value"))

    def step(cols: dict[str, list]) -> dict[str, list]:
        return {"value": [members(r) for r in cols["value"]]}

    packed = arrow_rows(lines, step, "value binary").select(F.col("value").cast("string").alias("value"))  # a string of any bytes
    packed.write.option("lineSep", "\0").option("compression", "none").text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """The records of an uncompressed stream: header fields, HTTP head, payload."""
    while version := stream.readline():
        if not version.strip():
            continue  # line breaks between records
        if not version.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            fields[name] = value
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield fields, http, payload


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records under ``path``, one row each (see ``SCHEMA``); archives of bounded size are the unit of work, and are decompressed as they are read."""

    target = arrow_schema(SCHEMA)

    def rows_of(data: memoryview) -> Iterator[tuple]:
        raw = io.BytesIO(data)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if bytes(data[:2]) == b"\x1f\x8b" else raw
        for fields, http, payload in parse(stream):
            heads = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
            yield (
                fields["WARC-Record-ID"][1:-1], fields["X-Page-ID"], fields["WARC-Type"], fields.get("WARC-Target-URI"), fields["WARC-Date"], int(heads["Content-Length"]),
                fields["WARC-Payload-Digest"][5:], fields.get("X-Refers-To-Page-ID"), fields.get("WARC-Refers-To", "")[1:-1] or None, payload if payloads else None,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for row in rows_of(memoryview(data.as_buffer())):
                    rows.append(row)
                    held += len(row[-1] or b"") + 400
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def archive(pages: DataFrame, min_bytes: int = 0, payloads: bool = True, **options) -> DataFrame:
    """Write the archives to the shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    write(pages, path, min_bytes, **options)
    return read(pages.sparkSession, path, payloads)
