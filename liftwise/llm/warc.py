"""WARC archives with equal payloads stored once.

Revisits are resolved by their headers: every record's header (id, URL, date, payload digest
and length, no payload) is stored, headers are shuffled by digest, and the smallest record
that has its payload becomes the original of its digest. All others are joined to it and
written as revisit records with fresh headers; the payload of a digest is written once. What
the archives hold already (a revisit without a payload) takes part: it is joined to its
original, or stays a revisit that refers to nothing when no record has the payload.

Payloads are never sorted or grouped. A task that writes a payload only has to know whether
its row is the original: the table of digests found more than once is broadcast while it is
small, and joined by a shuffle beyond. A digest of a third of all records is one row of that
table, and the headers joined to it are split like any skewed join.

An archive is a plain WARC 1.1 file that Spark's text writer writes and commits: a row is a
record, the line separator the two empty lines that end it. Files are started anew so that
one holds about ARCHIVE_BYTES, as a reader takes a file at a time.

Null payloads are empty. Null ids are larger than all others, and records without URL have no
target header. Records that repeat id, URL, date and payload are one response and revisits of
it. Line breaks in a URL are percent-encoded. An empty table gives empty archives. Columns
other than those named are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.llm.batches import small_batches, stored

ARCHIVE_BYTES = 64 << 20
# Digests of more than one record that are broadcast; more are joined by a shuffle.
BROADCAST_DIGESTS = 200_000
# Date of records that have none (fixed, so that archives are the same in every run).
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
# Digits of Spark's conv() to base 32 and those of RFC 4648 (fixed values).
PLAIN32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

HEADER = ["id", "url", "date"]
FOUND = (
    "record_id string, record_type string, source_id string, url string, date string,"
    " payload_digest string, payload_bytes long, refers_to string, refers_to_source string,"
    " payload binary"
)

ORACLE = """
WITH sized AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), named AS (
  SELECT page_id, url, payload_bytes,
    translate(array_to_string(list_transform(range(8),
        lambda i: to_base(('0x' || substr(h, (1 + 5 * i)::INTEGER, 5))::BIGINT, 32, 4)), ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM sized
), ranked AS (
  SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS original
  FROM named
  WINDOW same AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN original END AS refers_to
FROM ranked
"""


def digest32(data: Column) -> Column:
    """SHA-1 in base 32: eight times five hexadecimal digits to four of base 32."""
    sha = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(sha, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), PLAIN32, BASE32)


def page_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    date: str | None = None,
) -> DataFrame:
    """Records (id, url, date, payload, digest, n_bytes) of a table of pages."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(key).alias("id"),
        F.col(url).cast("string").alias("url"),
        (F.col(date).cast("string") if date else F.lit(DATE)).alias("date"),
        body.alias("payload"),
    ).withColumns({"digest": digest32(F.col("payload")), "n_bytes": F.octet_length("payload").cast("long")})


def archive_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of archives written before: their responses, resources and revisits."""
    found = read_archives(spark, path)
    return found.where(F.col("record_type").isin("response", "resource", "revisit")).select(
        F.coalesce("source_id", "record_id").alias("id"), "url", "date", "payload",
        F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("n_bytes"),
    )


def originals(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, first, ties): the smallest header with a payload of each digest that has more
    than one record, and how many records have that very header."""
    large = F.coalesce(F.col("n_bytes"), F.lit(min_bytes)) >= min_bytes
    same = (
        headers.where(F.col("digest").isNotNull() & large)
        .groupBy("digest", "has_payload", *HEADER)
        .agg(F.count(F.lit(1)).alias("ties"), F.min("row").alias("row"))
    )
    order = [x for c in HEADER for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    first = F.min(F.when(F.col("has_payload"), F.struct(*order, "ties", "row")))
    per_digest = same.groupBy("digest").agg(first.alias("first"), F.sum("ties").alias("n"))
    return per_digest.where("n > 1 AND first IS NOT NULL").select(
        "digest", "first", F.col("first.ties").alias("ties")
    )


def _line(name: str, value: Column) -> Column:
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _uuid(*parts: Column) -> Column:
    """A record id from what the record is, so that a job run again writes the same."""
    h = F.md5(F.concat_ws("\x00", *[F.coalesce(p.cast("string"), F.lit("\x01")) for p in parts]))
    cut = [F.substring(h, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _response_id(header: Column | None = None) -> Column:
    return _uuid(F.lit("response"), F.col("digest"), *[header[c] if header is not None else F.col(c) for c in HEADER])


def _record(kind: str, record_id: Column, block: Column, more: list[Column]) -> Column:
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"),
        _line("WARC-Record-ID", record_id),
        _line("WARC-Date", F.coalesce("date", F.lit(DATE))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Source-Id", F.col("id")),
        *more,
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    return F.concat(head, block).alias("value")


def _http() -> Column:
    """The response's header block; a revisit keeps it, so the payload's length stays known."""
    known = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    return F.coalesce(known, F.lit(""))


def write_archives(records: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row of (id, url, date, payload, digest, n_bytes): one response per
    digest, revisits that refer to it for the rest. Payloads of fewer than min_bytes bytes
    are always responses."""
    has = F.col("payload").isNotNull()
    slim = records.select(*HEADER, "digest", "n_bytes", has.alias("has_payload"))
    headers = stored(slim.withColumn("row", F.monotonically_increasing_id()), "headers")
    shared = stored(originals(headers, min_bytes), "originals")
    digests, tied = shared.agg(F.count("*"), F.max("ties")).first()
    few = shared if digests > BROADCAST_DIGESTS else F.broadcast(shared)

    revisits = (
        headers.join(shared.hint("merge"), "digest", "left")
        .where(F.coalesce(F.col("row") != F.col("first.row"), F.lit(False)) | ~F.col("has_payload"))
        .select(
            _record(
                "revisit", _uuid(F.lit("revisit"), F.col("digest"), F.col("row")), _http(),
                [
                    F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Truncated: length\r\n"),
                    _line("WARC-Refers-To", F.when(F.col("first").isNotNull(), _response_id(F.col("first")))),
                    _line("WARC-Refers-To-Target-URI", F.col("first.url")),
                    _line("WARC-Refers-To-Date", F.col("first.date")),
                    _line("X-Refers-To-Source-Id", F.col("first.id")),
                ],
            )
        )
    )

    same = F.lit(True)
    for c in HEADER:
        same = same & F.col(c).eqNullSafe(F.col(f"first.{c}"))
    alone = F.coalesce(F.col("n_bytes"), F.lit(0)) < min_bytes
    joined = records.where(has).join(few, "digest", "left")
    written = joined.where(F.col("first").isNull() | (same & (F.col("ties") == 1)))
    if (tied or 0) > 1:  # equal in all headers and the payload: any one of them is the response
        rest = [c for c in records.columns if c != "digest"]
        repeated = joined.where(same & (F.col("ties") > 1)).groupBy("digest")
        once = repeated.agg(*[F.first(c).alias(c) for c in rest])
        written = written.select(*records.columns).unionByName(once.select(*records.columns))
    body = F.concat(_http(), F.col("payload").cast("string"))
    record_id = F.when(alone, _uuid(F.lit("small"), F.uuid())).otherwise(_response_id())
    responses = written.select(_record("response", record_id, body, []))

    mean = headers.agg(F.avg(F.coalesce("n_bytes", F.lit(0)))).first()[0] or 0
    responses.unionByName(revisits).write.option("lineSep", END).option(
        "maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (mean + 600)))
    ).text(path)


def _records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(data) + member.flush())
            data = member.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {version[:40]!r}")
        head = {}
        for line in lines:
            name, _, value = line.partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        at = end + 4 + size + 4
        if at > len(data) or data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        yield head, data[end + 4 : end + 4 + size]


def _parsed(head: dict[str, str], block: bytes) -> tuple:
    kind, digest = head.get("warc-type"), head.get("warc-payload-digest")
    digest = digest.removeprefix("sha1:") if digest else None
    payload, n_bytes, http = None, None, b""
    if head.get("content-type", "").startswith("application/http"):
        http, _, block = block.partition(b"\r\n\r\n")
    if kind in ("response", "resource"):
        payload, n_bytes = block, len(block)
        found = base64.b32encode(hashlib.sha1(block).digest()).decode()
        if digest not in (None, found):
            raise ValueError(f"payload of {head.get('warc-record-id')} is not {digest}")
        digest = found
    elif kind == "revisit":
        for line in http.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                n_bytes = int(value)
    return (
        head.get("warc-record-id"), kind, head.get("x-source-id"), head.get("warc-target-uri"),
        head.get("warc-date"), digest, n_bytes, head.get("warc-refers-to"),
        head.get("x-refers-to-source-id"), payload,
    )


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the archives in a folder, plain or gzip. Payloads are checked against
    their digests; a damaged archive is an error."""
    small_batches(spark)
    wanted = ", ".join(f for f in FOUND.split(", ") if payload or not f.startswith("payload binary"))
    names = [f.split()[0] for f in wanted.split(", ")]
    types = {"long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], types.get(f.split()[1], pa.string())) for f in wanted.split(", ")])

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for head, block in _records_of(content.as_py()):
                    rows.append(_parsed(head, block))
                    held += len(block) if payload else 0
                    if len(rows) == 1000 or held > 8 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    def _batch(rows, schema):
        columns = list(zip(*rows, strict=True)) or [()] * (len(names) + (not payload))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema=schema
        )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, wanted)
