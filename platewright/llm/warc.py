"""Web archives without repeated payloads.

Headers (page, size and SHA-1 of the payload) are shuffled by digest; of pages with
equal payloads of some size the one with the largest id keeps its response record, and
the others become revisit records that name it. The archives are written by Spark's
text writer: a record ends with two line breaks, which is the writer's line separator,
and each file is compressed. Files are read back record by record by the lengths in
their headers, and revisits are joined to the responses they name.

Only digests and ids are shuffled. The digests that occur more than once come back to the
pages in a broadcast join where they are few (by their size), so payloads stay where they
are read; beyond that they are shuffled to them.

Defined results: a null payload is empty; a null url is the empty target; pages with a
null id are written but are never referred to, unless no page of the payload has an id
(all are responses then). Rows with the same id and payload are all responses or all
revisits. Line breaks and blanks in a url are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewright.operators.joins import is_small
from platewright.session import shared_folder

#: Payloads from this size on are stored once; records in a file; the date of the records.
MIN_BYTES, FILE_RECORDS, DATE = 1000, 5000, "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"


def with_headers(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``payload_bytes`` and ``payload_digest``."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
    )


def resolved(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Adds ``refers_to``: the page that has the response, null for a response itself."""
    twice = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.max("page_id").alias("original"), F.count("*").alias("n")
    ).where("n > 1 AND original IS NOT NULL").drop("n")
    shared_folder(headers.sparkSession)
    twice = twice.checkpoint()  # read for its size, then for the join
    found = headers.join(F.broadcast(twice) if is_small(twice) else twice, "payload_digest", "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return found.withColumn("refers_to", other).drop("original")


def records(found: DataFrame) -> DataFrame:
    """``value``: the text of each record up to the line breaks that end it."""
    target = F.col("url")
    for character in "\r\n\t ":
        target = F.replace(target, F.lit(character), F.lit(f"%{ord(character):02X}"))
    identity = F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    lines = [
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), identity),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{RECORD_ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(len(HTTP))).otherwise(F.col("payload_bytes") + len(HTTP))),
    ]
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    return found.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block).alias("value"))


def write_archives(found: DataFrame, folder: str, file_records: int = FILE_RECORDS) -> None:
    writer = records(found).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", file_records).text(folder)


def _parse(content: bytes):
    """``page_id``, type, target, digest, payload bytes and page referred to of each record."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(len(END)) != END.encode():
            raise ValueError(f"record {fields['WARC-Record-ID']} doesn't end where it should")
        payload, kind = memoryview(block)[len(HTTP) :], fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than its digest says")
        number = lambda x: None if x is None or x == "none" else int(x)
        page = number(fields["WARC-Record-ID"][len(RECORD_ID) + 1 : -1])
        other = fields.get("WARC-Refers-To")
        yield page, kind, fields["WARC-Target-URI"], digest, len(payload), number(other and other[len(RECORD_ID) + 1 : -1])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record; ``payload_bytes`` of a revisit are those of the response it names."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = list(zip(*_parse(content.as_py()))) or [[]] * 6
                types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                names = ["page_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    read = files.mapInArrow(
        parse, "page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long"
    )
    return read


def with_original_sizes(read: DataFrame) -> DataFrame:
    """The payload bytes of revisits, taken from the responses they name."""
    named = read.where("record_type = 'revisit'")
    originals = read.where("record_type = 'response'").join(
        named.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi"
    ).groupBy(F.col("page_id").alias("refers_to")).agg(F.max("payload_bytes").alias("full"))
    return read.join(originals, "refers_to", "left").withColumn(
        "payload_bytes", F.when(F.col("record_type") == "revisit", F.col("full")).otherwise(F.col("payload_bytes"))
    ).drop("full")
