"""WARC archives with revisit records, written and read by Spark alone.

A record ends with CR LF CR LF, which is also the line separator that Spark's
text sink is given: each row is a record, each file an archive (gzip), on any
file system that Spark writes to.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, written

END = "\r\n\r\n"
#: Payloads from this size on may be replaced by revisit records.
LEAST_BYTES = 1000
#: Revisits that are sent to all tasks (some 100 bytes each).
MOST_SENT = 1 << 19
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, uri string, page_id string, refers_to_id string, payload_digest string, payload binary"


def record_id(page: Column, digest: Column) -> Column:
    """A URN made from page id and digest, so that a record's id is known before it is written."""
    name = F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def revisits(headers: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit another, from
    headers (page_id, digest, n). Of equal payloads that of the largest
    page_id is the original. Only headers are shuffled; the largest id comes
    from a partial aggregate."""
    original = headers.where(F.col("n") >= LEAST_BYTES).groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1 and refers_to is not null")
    found = headers.join(original.select("digest", "n", "refers_to"), ["digest", "n"])
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 16 << 20) -> None:
    """One WARC record per row of pages into archives under path.

    Of records with equal payloads of LEAST_BYTES or more, the one of the
    largest id is a response and the others are revisit records, which carry
    no payload; rows that repeat both the id and the payload of a response
    are responses, too. Null payloads are empty and null urls are left empty;
    a record without an id is never the original of others. Other columns
    are not read. An archive has about archive_bytes of payload, or one record."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    headers = rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("n"))
    mean = headers.agg(F.avg("n")).first()[0] or 0
    again = written(revisits(headers).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to"), "revisits")
    # few decisions go to the payloads; many meet them in a shuffle
    few = again.limit(MOST_SENT + 1).count() <= MOST_SENT
    rows = rows.join(F.broadcast(again) if few else again.hint("merge"), F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")

    crlf = "\r\n"
    clean = lambda c: F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("again_digest").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length("payload"))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest"))),
        F.concat(F.lit("WARC-Target-URI: "), clean(F.col("url"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("WARC-Page-ID: "), clean(F.col("page_id").cast("string")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), size.cast("string")),
    ]
    record = F.concat(F.concat_ws(crlf, *fields), F.lit(END), http, F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))
    most = max(1, int(archive_bytes / max(1.0, mean)))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def _unzipped(data: bytes) -> bytes:
    """The content of a gzip file of one member or many; bytes that begin no further member are padding. Each byte is fed once."""
    view, at, out = memoryview(data), 0, []
    member = zlib.decompressobj(31)
    while at < len(view):
        piece = view[at : at + (1 << 16)]
        out.append(member.decompress(piece))
        at += len(piece) - len(member.unused_data)
        if member.eof:
            if view[at : at + 2] != b"\x1f\x8b":
                break
            member = zlib.decompressobj(31)
    if not member.eof:
        raise ValueError("a gzip member has no end")
    return b"".join(out)


def _records(data: bytes):
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].split(b"\r\n")
        if not head[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head[1:])}
        begin = end + 4
        at = begin + int(fields[b"content-length"])
        block = data[begin:at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4
        http = block.find(b"\r\n\r\n") if fields.get(b"content-type", b"").startswith(b"application/http") else -1
        yield fields, block[http + 4 :] if http >= 0 else block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for every record of the archives under path (gzip, of one member or
    one for each record, or plain; files of any name, but for those that begin
    with _ or a dot, which are not data to Spark): ids, type, uri, page_id, the
    digest its header tells, and its own payload (empty for revisits)."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = _unzipped(data)
                rows, size = [], 0
                for f, payload in _records(data):
                    text = lambda k, f=f: f[k].decode() if k in f else None
                    rows.append((text(b"warc-record-id"), text(b"warc-type"), text(b"warc-target-uri"), text(b"warc-page-id"), text(b"warc-refers-to"), (text(b"warc-payload-digest") or "").removeprefix("sha1:"), payload))
                    size += len(payload)
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "payload" else pa.string()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def resolved(records: DataFrame) -> DataFrame:
    """Every response, resource and revisit record with size and digest of its
    full payload; for revisits those of the response that they refer to, and
    its page_id as refers_to. Records of other types (warcinfo, request,
    metadata) hold no page and are left out.

    A revisit of which the response is not among records stays, with the digest that its header tells, a null size and a null refers_to."""
    own = records.select("record_id", "record_type", "page_id", "refers_to_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.col("payload_digest").alias("told"))
    response = own.where("record_type = 'response'").groupBy("record_id").agg(F.first("page_id").alias("at"), F.first("payload_bytes").alias("n"), F.first("payload_digest").alias("d"))
    plain = own.where("record_type in ('response', 'resource')").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to"))
    again = own.where("record_type = 'revisit'").select("page_id", "record_type", "told", F.col("refers_to_id").alias("record_id")).join(response, "record_id", "left")
    return plain.unionByName(again.select("page_id", F.col("n").alias("payload_bytes"), F.coalesce("d", "told").alias("payload_digest"), "record_type", F.col("at").alias("refers_to")))


def revisit_table(pages: DataFrame) -> DataFrame:
    """pages written to archives in the shared folder, read back and resolved."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    out = resolved(read_archives(spark, path))
    return out.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH each AS (SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
best AS (SELECT payload, max(page_id) AS best FROM each WHERE n >= 1000 GROUP BY payload HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, sha1(e.payload) AS payload_digest,
  CASE WHEN page_id <> best THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to
FROM each e LEFT JOIN best b ON e.payload = b.payload
"""
