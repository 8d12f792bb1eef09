"""Content-addressed WARC archive.

``write_archive`` keeps two tables in one folder: ``payloads`` holds each
distinct payload once under its SHA-256 digest, ``records`` holds the exact
header blocks of every record and the digest it points to.  Before anything is
written, each digest is verified to stand for one payload (equal length and a
second, independent hash over all its copies).  ``read_archive`` recomputes
every stored payload's digest, then rebuilds the records by a join on it.

A record is a ``response``; where payloads of at least ``REVISIT_BYTES`` are
equal, the one with the largest id is the response and the others are
``revisit`` records that refer to it.

Defined cases: null payload is empty; null url leaves the target line out; line
breaks in a url are percent-encoded so that they cannot end a header; a null id
is written as ``null``, read back as null and never referred to unless no other
exists; rows repeating the response's id are responses as well (the same
record); other columns do not matter; an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
CRLF = "\r\n"
# Fixed values of the record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT_TYPE = "application/http; msgtype=response"


def _lines(*lines: Column) -> Column:
    """Header lines, each ended by CRLF; a null line is left out."""
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z",
            revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(warc_header, http_header, digest) for each row of (page_id, url, payload)."""
    named = pages.select("page_id", "url", F.sha2("payload", 256).alias("digest"),
                         F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"),
                         F.xxhash64("payload").alias("second"))
    groups = named.groupBy("digest").agg(
        F.max("page_id").alias("owner"), F.min("size").alias("s0"), F.max("size").alias("s1"),
        F.min("second").alias("h0"), F.max("second").alias("h1"))
    same = (F.col("s0") == F.col("s1")) & (F.col("h0") == F.col("h1"))
    checked = groups.select("digest", F.when(same, F.col("owner")).otherwise(
        F.raise_error(F.lit("one digest stands for two payloads"))).alias("owner"))
    rows = named.join(checked, "digest")
    revisit = F.coalesce((F.col("size") >= revisit_bytes)
                         & ~F.col("page_id").eqNullSafe(F.col("owner")), F.lit(False))
    http = _lines(F.lit("HTTP/1.1 200 OK"),
                  F.lit("Content-Type: text/html; charset=utf-8"),
                  _header("Content-Length", F.col("size").cast("string")))
    http = F.concat(http, F.lit(CRLF))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    head = _lines(
        F.lit(VERSION),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _urn(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _one_line(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, _header("WARC-Refers-To", _urn(F.col("owner")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit(f"Content-Type: {CONTENT_TYPE}"),
        _header("Content-Length", block.cast("string")))
    return rows.select(F.concat(head, F.lit(CRLF)).alias("warc_header"),
                       http.alias("http_header"), "digest")


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write (page_id, url, payload binary) rows as an archive folder."""
    records(pages, date).write.option("compression", "zstd").parquet(f"{path}/records")
    once = pages.select(F.sha2("payload", 256).alias("digest"), "payload") \
        .dropDuplicates(["digest"])
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    value = F.regexp_extract("warc_header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def _page(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("bigint")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its fields, header blocks, payload and exact bytes."""
    heads = spark.read.parquet(f"{path}/records")
    stored = spark.read.parquet(f"{path}/payloads")
    intact = F.sha2("payload", 256) == F.col("digest")
    stored = stored.select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(intact, F.sha1("payload")).otherwise(
            F.raise_error(F.lit("a stored payload does not match its digest")))
        .alias("payload_digest"))
    rows = heads.join(stored, "digest")
    kind = _field("WARC-Type")
    body = F.when(kind == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("warc_header").cast("binary"), F.col("http_header").cast("binary"),
                      body, F.lit((CRLF * 2).encode()))
    return rows.select(
        _page(_field("WARC-Record-ID")).alias("page_id"), _field("WARC-Target-URI").alias("url"),
        kind.alias("record_type"), _page(_field("WARC-Refers-To")).alias("refers_to"),
        "payload_bytes", "payload_digest", "warc_header", "http_header", "payload",
        record.alias("record"))


def export_files(archive: DataFrame, path: str) -> None:
    """Write the records of ``read_archive`` as gzip WARC files: each line of the
    text sink is one record, and its separator the CRLF CRLF that ends it."""
    text = F.concat("warc_header", "http_header",
                    F.when(F.col("record_type") == "response", F.col("payload").cast("string"))
                    .otherwise(""))
    archive.select(text.alias("value")).write.option("lineSep", CRLF * 2) \
        .option("compression", "gzip").text(path)


def pages_as_payloads(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))


def warc_report(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages' archive to ``path`` and return what is read back."""
    write_archive(pages_as_payloads(pages), path)
    return read_archive(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
