"""WARC archives: writing captures, reading records, and assembling transactions.

Each capture is three records: request, response (or revisit of an equal payload) and metadata; request and metadata
name the response in WARC-Concurrent-To. Records go through Spark's text writer and reader, with the record end and
the version line as separators, so archives can lie in any store that Spark reaches, files are streamed, and a lost
task is simply run again. A file is one gzip member.

Assembly joins the auxiliary records to their response by the concurrent-to identifier; an auxiliary record that names
a request instead is followed one step. One nested row per capture results.

Defined results: a null payload is empty; null ids and urls are written as empty and read as null; repeated rows are
captures of their own, and of equal payloads the last row of the largest id is the response; an empty table gives an
empty archive and no rows; a response without request or metadata has null and an empty list there; auxiliary records
without a response are left out; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialise, pick, shared_dir, table

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: RFC 4648 letters for the digits of radix 32.
_RADIX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of SHA-1: five hex digits make four letters."""
    hexed = F.upper(F.sha1(data))
    four = lambda i: F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[four(i) for i in range(8)]), _RADIX32, _BASE32)


def _record(kind: str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    head = [F.lit(f"{VERSION}WARC-Type: {kind}\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\n")]
    for name, value in fields:
        head += [F.lit(f"{name}: "), value, F.lit("\r\n")]
    return F.concat(*head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def _urn(key: Column, n: Column, kind: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), n.cast("string"), F.lit(f":{kind}>"))


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0, stable: bool = False) -> None:
    """Write pages (page_id, url, html) as captures to the folder path.

    Rows are numbered by place; unless stable (a Parquet scan is), pages are written to the shared folder first, so
    that a task that is run again numbers its rows as before.
    """
    pages = pick(pages, {"page_id": "long", "url": "string", "html": "string"})
    if not stable:
        pages = materialise(pages)
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), sha1_base32(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("n"))
    # One row per repeated payload: partial maxima first, so a hot payload is no hot task; the join back can be split.
    first = (
        rows.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct(F.col("page_id"), F.col("n"))).alias("first"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select(F.col("digest").alias("d"), F.col("first.page_id").alias("first_id"), F.col("first.n").alias("first_n"))
    )
    joined = rows.join(first, F.col("digest") == F.col("d"), "left")
    own = _urn(F.col("page_id"), F.col("n"), "response")
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    page = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http;msgtype=response"))]
    revisit = F.col("first_n").isNotNull() & (F.col("first_n") != F.col("n"))
    main = F.when(
        revisit,
        _record("revisit", own, [*page, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", _urn(F.col("first_id"), F.col("first_n"), "response"))], http),
    ).otherwise(_record("response", own, page, F.concat(http, F.col("html"))))
    request = _record(
        "request",
        _urn(F.col("page_id"), F.col("n"), "request"),
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\nUser-Agent: siltstone\r\n\r\n")),
    )
    meta = _record(
        "metadata",
        _urn(F.col("page_id"), F.col("n"), "metadata"),
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string"), F.lit("\r\n")),
    )
    joined.select(F.concat(request, F.lit(END), main, F.lit(END), meta).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def parse_record(raw: bytes):
    """Fields of a record without its version line; None if the block isn't complete."""
    head, found, block = raw.partition(b"\r\n\r\n")
    if not found:
        return None
    fields: list[tuple[str, str]] = []
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields.append((name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()))
    headers = dict(fields)
    size = int(headers.get("content-length") or 0)
    if len(block) < size:
        return None
    return fields, headers, block[:size]


def _row(fields, headers, block, payloads: bool) -> dict:
    kind = headers.get("warc-type", "")
    payload, size, digest, http = block, len(block), None, ""
    if "application/http" in headers.get("content-type", ""):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        http = next((x.split(b":", 1)[1].strip().decode() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), "")
    if kind == "revisit":  # the payload lies in the record that is referred to
        size = int(http or 0)
        digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    elif kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_id": headers.get("warc-record-id"),
        "type": kind,
        "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"],
        "refers_to": headers.get("warc-refers-to"),
        "uri": headers.get("warc-target-uri") or None,
        "headers": fields and list(headers.items()),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if payloads and kind == "response" else None,
    }


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record. payloads: with the bytes of response payloads; digests are computed from them either way."""

    def run(batches):
        import pyarrow as pa

        kind = pa.schema(
            [("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("uri", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        held = b""
        for b in batches:
            rows, size = [], 0
            for piece in b.column(0):
                raw = piece.as_py() or b""
                if not held and not raw:
                    continue
                # A payload may hold the version line itself: put the pieces together again until the block is whole.
                held = held + VERSION.encode() + raw if held else raw
                parsed = parse_record(held)
                if parsed:
                    held = b""
                    rows.append(_row(*parsed, payloads))
                    size += rows[-1]["payload_bytes"] if payloads else 0
                if size > 16_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    lines = spark.read.option("lineSep", VERSION).text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, its request and its metadata records."""
    main = records.where(F.col("type").isin("response", "revisit"))
    aux = records.where(F.col("type").isin("request", "metadata")).select(
        "record_id", "type", F.explode("concurrent_to").alias("to"), F.struct("record_id", "uri", "headers").alias("record")
    )
    # A metadata record may name the request; the request then names the response.
    via = aux.where("type = 'request'").select(F.col("record_id").alias("via"), F.col("to").alias("end"))
    resolved = aux.join(via, F.col("to") == F.col("via"), "left").withColumn("key", F.coalesce("end", "to"))
    grouped = resolved.groupBy("key").agg(
        F.max_by(F.when(F.col("type") == "request", F.col("record")), F.when(F.col("type") == "request", F.col("record_id"))).alias("request"),
        F.array_sort(F.collect_set(F.when(F.col("type") == "metadata", F.col("record_id")))).alias("metadata"),
    )
    joined = main.join(grouped, F.col("record_id") == F.col("key"), "left")
    return joined.select(
        F.col("record_id").alias("capture"),
        F.struct("type", "record_id", "refers_to", "uri", "headers", "payload_bytes", "payload_digest", "payload").alias("response"),
        "request",
        F.coalesce("metadata", F.array().cast("array<string>")).alias("metadata"),
    )


def _page_of(urn: Column) -> Column:
    return F.expr(f"try_cast(regexp_extract({urn}, '^<urn:capture:(-?[0-9]*):', 1) as bigint)")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_archive(table(spark, sf_dir, "pages"), path, stable=True)
    # Parsed once: assembly looks at the records three times.
    captures = assemble(materialise(read_archive(spark, path, payloads=False)))
    return captures.select(
        _page_of("response.record_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        _page_of("response.refers_to").alias("refers_to"),
        F.col("request").isNotNull().alias("has_request"),
        F.size("metadata").alias("n_metadata"),
    )


QUERIES = {"op2_warc": op2_warc}
ORACLES = {
    "op2_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, row_number() OVER () AS n FROM pages
), q AS (
  SELECT *, first_value(page_id) OVER w AS top, first_value(n) OVER w AS top_n, upper(sha1(h)) AS x
  FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST, n DESC)
), d AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || x[5 * i + 1 : 5 * i + 5] AS BIGINT)) AS five,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS letters
  FROM q
)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(five, lambda v: letters[(v >> 15) + 1] || letters[((v >> 10) & 31) + 1] || letters[((v >> 5) & 31) + 1] || letters[(v & 31) + 1]), '') AS payload_digest,
  CASE WHEN n = top_n THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n <> top_n THEN top END AS refers_to, true AS has_request, CAST(1 AS INTEGER) AS n_metadata
FROM d
"""
}
