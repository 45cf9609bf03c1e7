"""WARC archives and their captures (operator 3).

Writing: a request, a response (or revisit) and a metadata record per
page.  Tasks pack them into archives of bounded bytes, one row each, which
Spark's text writer writes to a file each, so files are committed by Spark
and a lost task is simply run again.

Reading: archives are parsed in tasks into one row per record.  Assembly
brings the records of a capture together by the identifier they share:
requests and metadata name the response through WARC-Concurrent-To.  Each
capture becomes one nested row.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoscope.llm._bytes import PART, parts
from promoscope.llm._common import materialize, scratch_dir

NL = "\r\n"
#: Payloads shorter than this are always stored.
MIN_REVISIT = 100
#: Uncompressed bytes of an archive file; only the records of one page
#: may be larger.
ARCHIVE_BYTES = 16 << 20
#: The tables have no capture time; all records carry this one.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORD = ("type string, record_id string, concurrent_to string, target_uri string, date string, "
          "page string, refers_to string, digest string, fields string, payload binary, "
          "payload_bytes long, payload_sha256 string")


def _record(kind, rid, headers, body):
    """One record as text, without the separator that ends it."""
    lines = [F.lit("WARC/1.0"), F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: <"), rid, F.lit(">")), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in headers.items()]  # null: left out
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    return F.concat(F.concat_ws(NL, *lines), F.lit(NL + NL), body)


def _pack_batches(limit):
    """Joins records, in order, to archives of at most ``limit`` bytes."""
    end = (NL + NL).encode()

    def archive(held):
        return pa.RecordBatch.from_arrays(
            [pa.array([end.join(held)], pa.binary()).cast(pa.string())], names=["value"])

    def run(batches):
        held, size = [], 0
        for b in parts(batches, 0):
            for record in b.column(0).to_pylist():
                if held and size + len(record) + len(end) > limit:
                    yield archive(held)
                    held, size = [], 0
                held.append(record)
                size += len(record) + len(end)
        if held:
            yield archive(held)
    return run


def write_archives(pages: DataFrame, path: str, folder: str) -> None:
    """Archives of pages (page_id, url, html) under ``path``.

    The payload is the html in UTF-8 (null: empty).  Of pages with equal
    payloads of at least MIN_REVISIT bytes the one with the least page_id
    is stored, the others refer to it; rows that share that least
    page_id, and rows when all page_ids are null, are stored.
    """
    flat = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20]", "%20")
    base = (pages.select("page_id", flat.alias("url"), F.coalesce("html", F.lit("")).alias("html"))
            .withColumn("digest", F.sha2("html", 256))
            .withColumn("bytes", F.octet_length("html").cast("long")))
    first = (base.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    first = materialize(first.select("digest", "first"), folder, "first")
    p = base.join(first, "digest", "left").withColumn("capture", F.expr("uuid()"))
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(),
                       F.lit(False))
    capture = F.concat(F.lit("urn:uuid:"), F.col("capture"))
    about = F.concat(F.lit("<"), capture, F.lit(">"))
    page = F.col("page_id").cast("string")
    ref = F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + NL + "Content-Type: text/html; charset=utf-8" + NL
                          + "Content-Length: "), F.col("bytes").cast("string"), F.lit(NL + NL))
    uri = {"WARC-Target-URI": F.col("url")}
    response = _record(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")), capture,
        uri | {"Content-Type": F.lit("application/http; msgtype=response"),
               "WARC-Page-ID": page,
               "WARC-Payload-Digest": F.concat(F.lit("sha256:"), F.col("digest")),
               "WARC-Profile": F.when(again, F.lit(PROFILE)), "WARC-Refers-To": ref},
        F.when(again, http).otherwise(F.concat(http, F.col("html"))))
    request = _record(
        F.lit("request"), F.concat(capture, F.lit("-request")),
        uri | {"Content-Type": F.lit("application/http; msgtype=request"), "WARC-Concurrent-To": about},
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1" + NL + NL)))
    metadata = _record(
        F.lit("metadata"), F.concat(capture, F.lit("-metadata")),
        uri | {"Content-Type": F.lit("application/warc-fields"), "WARC-Concurrent-To": about},
        F.concat_ws(NL, F.concat(F.lit("page_id: "), page),
                    F.concat(F.lit("payload_bytes: "), F.col("bytes").cast("string"))))
    (p.select(F.concat_ws(NL + NL, request, response, metadata).cast("binary").alias("value"))
     .mapInArrow(_pack_batches(ARCHIVE_BYTES), "value string")
     .write.option("lineSep", NL + NL).option("compression", "gzip")
     .option("maxRecordsPerFile", 1).text(path))


def _inflated(content: bytes) -> bytes:
    """A gzip file, also of several members; other bytes as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        out.append(z.decompress(content))
        content = z.unused_data
    return b"".join(out)


def parse_archive(data: bytes):
    """Yields (headers with lower-case names, block) of each record."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"truncated WARC record at byte {at}")
        yield headers, block
        at = end + 4 + size


def _row(headers, block):
    kind = headers.get("warc-type", "")
    bare = headers.get
    http = "msgtype=response" in bare("content-type", "")
    payload = block[block.find(b"\r\n\r\n") + 4:] if http and b"\r\n\r\n" in block else block
    stored = kind == "response"
    digest = bare("warc-payload-digest")
    return {
        "type": kind, "record_id": bare("warc-record-id", "").strip("<>") or None,
        "concurrent_to": bare("warc-concurrent-to", "").strip("<>") or None,
        "target_uri": bare("warc-target-uri"), "date": bare("warc-date"),
        "page": bare("warc-page-id"), "refers_to": bare("warc-refers-to", "").strip("<>") or None,
        "digest": digest.partition(":")[2] if digest else None,
        "fields": block.decode("utf-8", "replace") if kind == "metadata" else None,
        "payload": payload if stored else None, "payload_bytes": len(payload) if stored else None,
        "payload_sha256": hashlib.sha256(payload).hexdigest() if stored else None}


def _parse_batches(schema):
    def run(batches):
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for headers, block in parse_archive(_inflated(content.as_py())):
                    rows.append(_row(headers, block))
                    size += len(block) + 500
                    if size > PART:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    string, number = pa.string(), pa.int64()
    kinds = {"string": string, "long": number, "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in RECORD.split(", "))])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_parse_batches(schema), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture, request, response, metadata).

    Requests and metadata records meet the response or revisit that their
    concurrent-to names; a missing part is null, of several the first
    counts.  One shuffle by that identifier serves all three sides.
    """
    kind = F.col("type")

    def part(types, column):
        return F.first(F.when(kind.isin(*types), F.col(column)), ignorenulls=True)

    main, ask, info = ("response", "revisit"), ("request",), ("metadata",)
    sides = {
        "request": (ask, ["record_id", "target_uri", "date"]),
        "response": (main, ["type", "record_id", "target_uri", "date", "page", "refers_to", "digest",
                            "payload", "payload_bytes", "payload_sha256"]),
        "metadata": (info, ["record_id", "fields"]),
    }
    found = records.where(kind.isin(*main, *ask, *info)).groupBy(
        F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        *[part(types, c).alias(f"{side}_{c}") for side, (types, cols) in sides.items() for c in cols])
    return found.select("capture", *[
        F.when(F.col(f"{side}_record_id").isNotNull(), F.struct(
            *[F.col(f"{side}_{c}").alias(c) for c in cols])).alias(side)
        for side, (_, cols) in sides.items()])


def _field(name):
    return F.regexp_extract("metadata.fields", f"(?m)^{name}: (-?\\d+)\r?$", 1)


def page_captures(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives, reads them back and returns per page
    page_id, payload_bytes, payload_digest, record_type and refers_to.

    One row per row of ``pages``, repeated ones too; null urls and htmls
    are empty, null page ids stay null, an empty table gives no rows.
    Page ids are whole numbers.  Columns other than page_id, url and html
    are left out.  A page's html, however long, is one record.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark)
    write_archives(pages, f"{folder}/warc", folder)
    kind = pages.schema["page_id"].dataType.simpleString()

    def number(text, to):
        return F.when(text != "", text.cast(to))

    c = assemble(read_records(spark, f"{folder}/warc"))
    r = F.col("response")
    return c.select(
        number(_field("page_id"), kind).alias("page_id"),
        F.coalesce(r["payload_bytes"], number(_field("payload_bytes"), "long")).alias("payload_bytes"),
        F.coalesce(r["payload_sha256"], r["digest"]).alias("payload_digest"),
        r["type"].alias("record_type"),
        number(F.regexp_extract(F.coalesce(r["refers_to"], F.lit("")), "^urn:page:(-?\\d+)$", 1), kind)
        .alias("refers_to"))
