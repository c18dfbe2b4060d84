"""WARC archives in which repeated payloads are revisit records.

Only headers (id, digest, length) are shuffled to find repeated payloads; page texts are written by
the task that reads them. Archives are written by Spark's text writer: a record's block ends in two
line ends, which is the writer's line separator, so the files are plain WARC/1.1 and take part in
Spark's commit protocol. They are read back as bytes, cut by Content-Length.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.shared import cut

MIN_BYTES = 1000
# Digests repeated among documents are broadcast up to this many rows of about 60 bytes.
MAX_BROADCAST_ROWS = 200_000
# Records in an archive file; files are read back whole.
RECORDS_PER_FILE = 2_000
END = "\r\n"
# Fixed value: the profile that the WARC 1.1 standard names for equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "record_id string, record_type string, page_id bigint, url string, payload_digest string, "
    "payload_bytes bigint, refers_to_id string, payload binary")


def headers(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with payload, its digest and its length in bytes."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        F.sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"))


def originals(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per digest met in several records: the greatest page_id, whose record is the response."""
    return (
        heads.where(F.col("payload_bytes") >= min_bytes)
        .select("page_id", "payload_digest")
        .groupBy("payload_digest").agg(
            F.max("page_id").alias("original"), F.count("*").alias("copies"))
        .where("copies > 1 and original is not null").select("payload_digest", "original"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES,
            max_broadcast: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Headers and payloads of `pages` with `original`, null for a response.

    Rows that repeat the response's page_id and payload are responses too. A null page_id is never
    the original, unless all copies have none: then all are responses.
    """
    heads = headers(pages)
    repeated = cut(originals(heads, min_bytes))
    if repeated.count() <= max_broadcast:
        repeated = F.broadcast(repeated)
    revisits = ~F.col("original").eqNullSafe(F.col("page_id"))
    return heads.join(repeated, "payload_digest", "left").withColumn(
        "original", F.when(revisits, F.col("original")))


def record_id(page_id: Column, digest: Column) -> Column:
    """A name-based UUID of the record, the same whenever it is written."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    parts = [h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record_text(resolved: DataFrame, date: Column) -> Column:
    """The record of one row, without the two line ends that close it."""
    revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END + END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)  # null, and so left out, if the value is

    # A header value must stay on its line: control characters are percent-encoded.
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.date_format(F.to_utc_timestamp(date, F.current_timezone()),
                                        "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(
            revisit, record_id(F.col("original"), F.col("payload_digest")))),
        line("X-Page-ID", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, date: Column | None = None) -> None:
    """Write `pages` (page_id, url, html) to `folder` as deduplicated WARC files."""
    resolved = resolve(pages, min_bytes)
    date = F.current_timestamp() if date is None else date
    (resolved.select(record_text(resolved, date).alias("value"))
     .write.option("lineSep", END + END).option("maxRecordsPerFile", records_per_file)
     .text(folder))


def parse(data: bytes):
    """Records of an archive: header dict and block."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = dict(
            re.split(": ?", x, maxsplit=1) for x in data[at:stop].decode().split(END)[1:])
        begin = stop + 4
        end = begin + int(head["Content-Length"])
        yield head, data[begin:end]
        at = end + 4


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record. A revisit has its payload's digest, but neither length nor payload."""
    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows = []
                for head, block in parse(data.as_buffer().to_pybytes()):
                    full = head["WARC-Type"] == "response"
                    payload = block[block.index(b"\r\n\r\n") + 4:] if full else None
                    page = head.get("X-Page-ID")
                    rows.append((
                        head["WARC-Record-ID"], head["WARC-Type"], int(page) if page else None,
                        head.get("WARC-Target-URI"),
                        hashlib.sha1(payload).hexdigest() if full
                        else head["WARC-Payload-Digest"].removeprefix("sha1:"),
                        len(payload) if full else None, head.get("WARC-Refers-To"), payload))
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, t) for c, t in zip(
                        zip(*rows, strict=True) if rows else [()] * 8,
                        (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
                         pa.int64(), pa.string(), pa.binary()), strict=True)],
                    [f.split()[0] for f in RECORD_SCHEMA.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Headers of the records; revisits get the length and page_id of what they refer to."""
    heads = cut(records.drop("payload"))
    full = heads.where("record_type = 'response'").groupBy(
        F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full_bytes"))
    wanted = full.join(
        heads.where("refers_to_id is not null").select("refers_to_id").distinct(),
        "refers_to_id", "left_semi")
    return heads.join(wanted, "refers_to_id", "left").select(
        "page_id", "url",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to")
