"""WARC records in a content-addressed archive.

The archive is two tables under one path.  ``payloads`` has every different
payload once, under its SHA-256 digest; ``heads`` has, for every record, its
exact header bytes (the WARC header and the HTTP header) and the digest of
its payload.  Records are put together again by joining the two.

Equal digests are verified: all payloads of one digest must have the same
length and the same independent 64-bit hash, and on reading, each payload's
digests are computed again; a difference is an error, not a wrong record.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ident

#: RFC 4648 alphabet and the WARC profile of revisits (fixed values).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column (32 characters)."""
    digits = F.sha1(payload)
    out = []
    for i in range(8):  # five hexadecimal digits are 20 bits, four letters
        n = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letter = F.shiftright(n, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substr(F.lit(BASE32), letter, F.lit(1)))
    return F.concat(*out)


def _payload(html_col: str) -> Column:
    return F.encode(F.coalesce(ident(html_col), F.lit("")), "UTF-8")


def _uri(column: str) -> Column:
    """A line break would end the header line."""
    return F.regexp_replace(F.regexp_replace(ident(column), "\r", "%0D"), "\n", "%0A")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", least_revisit: int = 0, date: str = DATE) -> None:
    """One record per row of ``pages``, in the archive at ``path``.

    Of records with equal payloads of ``least_revisit`` bytes or more, that with
    the largest id is the response and the others revisit it; smaller payloads
    are all responses.  A null html is an empty payload, a record without URL
    has no target line, and repeated rows of the largest id are all responses
    (the payload is stored once).  Other columns are ignored.  An empty table
    gives an empty archive.
    """
    spark = pages.sparkSession
    rows = pages.select(ident(id_col).alias("page_id"), _uri(url_col).alias("url"), _payload(html_col).alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    check = F.xxhash64("payload", F.octet_length("payload"))
    same = F.min(check) == F.max(check)
    (rows.groupBy("key").agg(
        F.max("page_id").alias("response_id"),
        F.when(same, F.first("payload")).otherwise(
            F.raise_error(F.lit("two payloads have the same digest"))).alias("payload"))
     .write.parquet(f"{path}/payloads"))
    stored = spark.read.parquet(f"{path}/payloads").select("key", "response_id")

    heads = rows.select("page_id", "url", "key", F.octet_length("payload").cast("long").alias("bytes"),
                        base32_sha1(F.col("payload")).alias("digest")).join(stored, "key")
    revisit = (F.col("bytes") >= least_revisit) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END + END))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(END))

    head = F.concat(
        F.lit("WARC/1.1" + END),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
                   line("WARC-Record-ID", F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">")))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))).cast("string")),
        F.lit(END), http)
    heads.select("page_id", "key", F.encode(head, "UTF-8").alias("head")).write.parquet(f"{path}/heads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record again: ``page_id``, ``head``, ``record_type``, ``refers_to``, ``target``,
    ``payload`` (of a revisit: that which it refers to), ``payload_digest`` and
    ``record``, the exact bytes of the WARC record.

    A payload whose bytes no longer have the digest of its record is an error.
    """
    heads, payloads = spark.read.parquet(f"{path}/heads"), spark.read.parquet(f"{path}/payloads")
    text = F.decode("head", "UTF-8")

    def field(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)

    parsed = heads.select(
        "page_id", "key", "head", field("WARC-Type").alias("record_type"),
        F.nullif(F.regexp_extract(text, r"\r\nWARC-Refers-To: <urn:page:([^>]*)>\r\n", 1), F.lit("")).alias("refers_to"),
        F.nullif(field("WARC-Target-URI"), F.lit("")).alias("target"),
        F.regexp_extract(text, r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]*)\r\n", 1).alias("stated"))
    sound = payloads.select("key", F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload has another digest"))).alias("payload"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    joined = parsed.join(sound, "key")
    return joined.select(
        "page_id", "head", "record_type", F.col("refers_to").cast(heads.schema["page_id"].dataType).alias("refers_to"),
        "target", "payload",
        F.when(F.col("stated") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
            F.raise_error(F.lit("a record states another digest"))).alias("payload_digest"),
        F.concat("head", F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")),
                 F.lit(b"\r\n\r\n")).alias("record"))
