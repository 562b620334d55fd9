"""WARC archives: writing captures, reading records, assembling transactions.

*Writing* (:func:`write`): a capture becomes three records, ``request``,
``response`` (or ``revisit``) and ``metadata``; request and metadata name the
response's record id in ``WARC-Concurrent-To``.  Of captures with equal
payloads of at least ``min_revisit`` bytes the one with the largest id is
written as response and the others as ``revisit`` records that refer to it and
carry no payload.  Every row is a capture of its own, with record ids of its
own: rows that repeat the largest id are responses all, and revisits refer to
one of them; a row without an id is a response whose metadata names no
``capture-id``.  Spark's text writer writes the archives (records end with
two line breaks, which is the writer's line separator), so any file system
that Spark knows will do.  The records of one capture are written together.
Files hold about ``FILE_BYTES`` before compression: captures of at most :data:`LARGE` times the
mean payload are written so many to a file as fit by the mean, larger ones so many as fit
by the largest, so that no run of long payloads makes a file of more than ``LARGE`` times that, or of
a single capture.

*Reading* (:func:`read`): archives are read as binary files and cut into
records by their Content-Length, so that payloads may hold anything.  A file
is one row, so archives are to be of moderate size; :func:`write` sees to that.

*Assembly* (:func:`transactions`): request, metadata and response records
are joined through the concurrent-to ids, and a revisit is joined with the
response that it refers to; one nested row per capture results.

Null payloads are written as empty ones.  A null URL is written as an empty
target.  Payloads of any length are written, read and hashed whole.  An empty table gives no
archive and no rows; other columns are not read.  Digests are SHA-1 of the payload, in lower-case hex; equal payloads
are found by SHA-256.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.sources.scratch import materialize, scratch_path

VERSION = "WARC/1.1"
FILE_BYTES = 16 << 20
#: Times the mean payload beyond which captures have files of their own.
LARGE = 4
MIN_REVISIT = 1000
_END = "\r\n\r\n"
_HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
          "payload_digest string, payload_bytes long, fields map<string,string>, payload binary")


def _record_id(kind: str, capture: Column, row: Column) -> Column:
    """A ``urn:uuid`` of a record: from its kind, the capture's id (may be null) and the number of its row."""
    h = F.md5(F.concat(F.lit(kind + ":"), F.coalesce(capture.cast("string"), F.lit("")), F.lit(":"), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, record_id: Column, uri: Column, date: str, block: Column, *headers: tuple[str, Column]) -> Column:
    """The text of one record; headers with a null value are left out."""
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record_id),
             F.concat(F.lit("WARC-Target-URI: "), uri), F.lit(f"WARC-Date: {date}"),
             *[F.concat(F.lit(f"{name}: "), value) for name, value in headers],
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), block)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_revisit: int = MIN_REVISIT, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Write the captures ``pages`` to new archives under ``path``.

    Ids may be null or repeated.  The captures are written once with a number
    for each row, so that all uses see the same numbers.  Only digests are
    shuffled to find equal payloads, combined on each task first."""
    captures = pages.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_replace(url_col, r"[\r\n]", ""), F.lit("")).alias("uri"),
                            F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    captures = materialize(captures.withColumn("equal", F.sha2("payload", 256)).withColumn(
        "row", F.monotonically_increasing_id()).withColumn("bytes", F.octet_length("payload")), "numbered-captures")
    mean, largest = captures.agg(F.coalesce(F.avg("bytes"), F.lit(0.0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    groups = captures.where("id is not null").where(F.col("bytes") >= min_revisit).groupBy("equal").agg(
        F.max(F.struct("id", "row")).alias("original"), F.count("id").alias("n")).where("n > 1").select("equal", "original")
    # Written first: its size is known when the join is planned, and a hot payload's captures can be split.
    captures = captures.join(materialize(groups, "equal-payloads"), "equal", "left").withColumn(
        "refers", F.when(F.col("original.id") != F.col("id"), F.col("original")))
    uri, capture, row, revisit = F.col("uri"), F.col("id"), F.col("row"), F.col("refers").isNotNull()
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload")))
    own = _record_id("response", capture, row)
    to = ("WARC-Concurrent-To", own)
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", own, uri, date, F.concat(F.lit(_HTTP_OK), F.col("payload")), http, digest)
    again = _record("revisit", own, uri, date, F.lit(_HTTP_OK), http, digest,
                    ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                    ("WARC-Refers-To", _record_id("response", F.col("refers.id"), F.col("refers.row"))))
    request = _record("request", _record_id("request", capture, row), uri, date,
                      F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\n\r\n")),
                      ("Content-Type", F.lit("application/http; msgtype=request")), to)
    metadata = _record("metadata", _record_id("metadata", capture, row), uri, date,
                       F.coalesce(F.concat(F.lit("capture-id: "), capture.cast("string"), F.lit("\r\n")), F.lit("")),
                       ("Content-Type", F.lit("application/warc-fields")), to)
    text = F.concat(F.when(revisit, again).otherwise(response), F.lit(_END), request, F.lit(_END), metadata)
    large = F.col("bytes") > LARGE * mean
    for part, chosen, size in (("regular", ~large, mean), *([("large", large, largest)] if largest > LARGE * mean else [])):
        captures.where(chosen).select(text.alias("value")).write.option("lineSep", _END).option(
            "maxRecordsPerFile", max(1, int(FILE_BYTES / (size + 1500)))).option("compression", compression).text(f"{path}/{part}")


def fields_of(block: bytes) -> dict[str, str]:
    """Named fields, one a line; names in lower case."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines) if colon}


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while True:
        while content[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        end = content.index(b"\r\n\r\n", at)
        if content[at:at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        fields = fields_of(content[content.index(b"\r\n", at) + 2:end])
        start = end + 4
        at = start + int(fields["content-length"])
        if at > len(content):
            raise ValueError(f"archive ends within the record at byte {start}")
        yield fields, content[start:at]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives (plain or gzip) under ``path``.  The fields
    of an ``application/warc-fields`` block are added to ``fields``.  The digest and size are
    those of the payload that was read (of the message body where the block is
    an HTTP message); a revisit has its header's digest and a null size.
    Without ``payloads`` their bytes are not handed on."""
    schema = RECORD if payloads else RECORD.replace(", payload binary", "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.string()] * 7, pa.int64(), pa.map_(pa.string(), pa.string()), *[pa.binary()] * payloads]
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                content = content.as_py()
                if content[:2] == b"\x1f\x8b":
                    content = gzip.decompress(content)
                for fields, block in records_in(content):
                    if fields.get("content-type") == "application/warc-fields":
                        fields = fields_of(block) | fields
                    if "application/http" in fields.get("content-type", ""):
                        block = block.partition(b"\r\n\r\n")[2]
                    revisit = fields.get("warc-type") == "revisit"
                    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] if revisit else hashlib.sha1(
                        block).hexdigest()
                    rows.append((fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-concurrent-to"),
                                 fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"),
                                 digest, None if revisit else len(block), list(fields.items()), block)[: len(names)])
                    held += len(block)
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, schema)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id, target_uri, date``, the
    ``response`` (a revisit's with the digest in its header and the size of
    the response that it refers to), the ``request`` and the ``metadata``
    records that are concurrent to it, as structs of the record's columns; null
    where an archive has none.  Of several concurrent records of a kind, the
    one with the smallest record id is taken."""
    inner = [c for c in records.columns if c not in ("concurrent_to",)]

    def concurrent(kind: str) -> DataFrame:
        mine = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return mine.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min_by(F.struct(*inner), "record_id").alias(kind))

    responses, revisits = (records.where(F.col("type") == kind) for kind in ("response", "revisit"))
    sizes = responses.select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("_size"))
    revisits = revisits.drop("payload_bytes").join(sizes, "refers_to", "left").withColumnRenamed("_size", "payload_bytes")
    captures = responses.unionByName(revisits)
    captures = captures.select("record_id", "target_uri", "date", F.struct(*inner).alias("response"))
    return captures.join(concurrent("request"), "record_id", "left").join(concurrent("metadata"), "record_id", "left")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, read them back and assemble the captures;
    returns per row ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``, taken from the archives alone.  (Payloads are read and
    hashed; their bytes are not carried through the joins.)"""
    spark = pages.sparkSession
    path = f"{scratch_path(spark, 'warc')}/archives"
    write(pages, path)
    records = materialize(read(spark, path, payloads=False), "records")
    captures = transactions(records).select(
        "record_id", F.col("metadata.fields")["capture-id"].cast("long").alias("page_id"), "response.payload_bytes",
        "response.payload_digest", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("original"))
    captures = materialize(captures, "captures")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = captures.where("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("original"), F.col("page_id").alias("refers_to"))
    revisits = captures.where("record_type = 'revisit'").join(named, "original", "left")
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).union(revisits.select(*columns))


__all__ = ["read", "records_in", "round_trip", "transactions", "write"]
