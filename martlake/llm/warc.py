"""A content-addressed archive of WARC records.

A payload's bytes are stored once, under their SHA-256; every record keeps its exact header block beside that digest.
Records are put together again by a join of the two, and each stored payload is hashed again when it is read, so that
a damaged or wrongly joined payload stops the job.  Of the records with equal payloads of at least ``min_bytes`` bytes
the one with the smallest id is a ``response`` and the others are ``revisit`` records that refer to it.

Tables below one folder:

* ``payloads`` - digest (SHA-256, hex), payload;
* ``records``  - digest, header (the exact header block, with its empty line).

Defined results: a null payload is empty; a very long one is one row, hashed and stored whole; a null id is larger than any other, and ties between rows with equal ids
go to the smaller address, then to the earlier row, so that exactly one is the response; line breaks in an address
are percent-encoded, a null one leaves its header out; other columns are not read; an empty table gives an empty
archive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm.common import map_arrow, written

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """The SHA-1 as WARC headers have it: 32 characters of 5 bits."""
    digest, out = F.sha1(payload), []
    for group in range(8):  # five hexadecimal digits are four characters
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _urn(*key: Column) -> Column:
    h = F.md5(F.concat_ws("/", *[F.coalesce(k.cast("string"), F.lit("-")) for k in key]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                    F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))


def write_archive(rows: DataFrame, folder: str, min_bytes: int = 0, date: str = "2026-01-01T00:00:00Z") -> None:
    """``rows``: id long, uri string, payload binary."""
    rows = rows.select(F.col("id").cast("long").alias("id"), "uri", F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # equal payloads meet in their map task first, so a payload of very many records is shuffled once a task
    (rows.groupBy("digest").agg(F.min("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{folder}/payloads"))
    size = F.octet_length("payload")
    facts = written(rows.select(F.monotonically_increasing_id().alias("row_id"), "id", "uri", "digest", size.alias("n"),
                                sha1_base32(F.col("payload")).alias("sha1")), "warc-facts")

    of = F.struct(F.col("id").isNull().alias("no_id"), "id", "uri", "row_id")
    first = written(facts.groupBy("digest").agg(F.min(of).alias("first"))
                    .select("digest", F.col("first.row_id").alias("first_row"), F.col("first.id").alias("first_id")),
                    "warc-first")

    joined = facts.join(first, "digest")
    revisit = (F.col("row_id") != F.col("first_row")) & (F.col("n") >= min_bytes)
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("row_id"), F.col("id"))), _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", uri), F.lit("")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _urn(F.col("first_row"), F.col("first_id"))),
            F.coalesce(_line("X-Refers-To-Id", F.col("first_id")), F.lit("")))).otherwise(""),
        F.coalesce(_line("X-Id", F.col("id")), F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("n"))), F.lit("\r\n"))
    joined.select("digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{folder}/records")


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The stored payloads, each hashed again."""
    stored = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    same = F.sha2("payload", 256) == F.col("digest")
    return stored.withColumn("payload", F.when(same, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), "digest"))))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    def field(name: str) -> Column:
        found = F.regexp_extract(text, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(found == "", None).otherwise(found)

    text = F.decode("header", "UTF-8")
    return spark.read.schema("digest string, header binary").parquet(f"{folder}/records").select(
        "digest", "header", field("X-Id").cast("long").alias("id"), field("WARC-Type").alias("record_type"),
        field("X-Refers-To-Id").cast("long").alias("refers_to"), field("WARC-Target-URI").alias("uri"))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record as it was: its header, fields of it, and the full payload (for revisits too)."""
    return _records(spark, folder).join(_payloads(spark, folder), "digest")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type, refers_to of every record; sizes and digests are taken from
    the stored bytes once a payload, before the join."""
    facts = _payloads(spark, folder).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                            sha1_base32(F.col("payload")).alias("payload_digest"))
    return _records(spark, folder).join(facts, "digest").select(
        "id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def export_warc(spark: SparkSession, folder: str, out: str) -> None:
    """The archive as WARC files; revisit records have no block."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    (read_archive(spark, folder).select(F.concat("header", block).cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").text(out))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column(0):
            raw, at, out = data.as_buffer().to_pybytes(), 0, []
            while at < len(raw):
                end = raw.index(b"\r\n\r\n", at) + 4
                header = raw[at:end]
                n = int(re.search(rb"\r\nContent-Length: *(\d+)", header)[1])
                out.append((header, raw[end:end + n]))
                at = end + n + 4
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)],
                                             ["header", "block"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header, block of every record of WARC files; a file is read whole by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    return map_arrow(files, _parse, "header binary, block binary")
