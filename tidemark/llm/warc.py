"""A content-addressed WARC archive: payload bytes once, exact headers per record, records rebuilt by joins.

1. A page becomes a record: WARC header, HTTP header, payload. Payloads are named by their SHA-256. That two payloads of one
   name are the same is verified by their lengths and their SHA-1, and a stored payload is hashed again when it is read.
2. The record with the largest page id among equal payloads is the response, the others revisit it. That takes the
   names and ids only, aggregated before they are shuffled.
3. ``payloads`` holds each payload once, ``headers`` the header bytes of every record, to the last line break.
4. Reading joins the two. A payload that more than a thousandth of the records share (there are at most a thousand of those)
   is joined in that many parts of the records, so no task has more than a thousandth of them.

Everything up to the export of files is DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows
from tidemark.sources.storage import shared_dir, stored, write_parquet

#: A payload with more records than this share of all, and than this number, is a hot one.
HOT_SHARE, HOT_LEAST = 1000, 4096

_BREAK = "\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Two tables: payloads (digest, payload) and headers (page_id, digest, header)."""

    path: str
    id_type: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest binary, payload binary").parquet(f"{self.path}/payloads")

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"page_id {self.id_type}, digest binary, header binary").parquet(f"{self.path}/headers")


def base32(hexadecimal: Column) -> Column:
    """The base32 text of a digest given as hex, whose length is a multiple of five digits (SHA-1 has forty)."""
    parts = F.transform(
        F.sequence(F.lit(0), (F.length(hexadecimal) / 5).cast("int") - 1),
        lambda i: F.lpad(F.conv(F.substring(hexadecimal, i * 5 + 1, F.lit(5)), 16, 32), 4, "0"),
    )
    return F.translate(F.array_join(parts, ""), _DIGITS, _ALPHABET)


def _line(name: str, value: Column) -> Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_BREAK)), F.lit(""))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def header_text(page: Column, url: Column, n: Column, sha1: Column, refers_to: Column, revisit: Column, date: str) -> Column:
    """The WARC header and the HTTP header, both with the empty line at their end. Line breaks in a URL are escaped."""
    address = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}"),
        _line("Content-Length", n.cast("string")),
        F.lit(_BREAK),
    )
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(n)
    return F.concat(
        F.lit(f"WARC/1.1{_BREAK}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(page)),
        _line("WARC-Target-URI", address),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(sha1))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(refers_to))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(_BREAK),
        http,
    )


def hot_payloads(names: DataFrame) -> DataFrame:
    """(digest, parts) of the payloads that many records share; ``names`` has (digest, n). At most ``HOT_SHARE`` rows."""
    total = names.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_SHARE)
    return stored(names.where(F.col("n") > limit).select("digest", F.ceil(F.col("n") / limit).cast("int").alias("parts")))


def joined(records: DataFrame, names: DataFrame, hot: DataFrame) -> DataFrame:
    """``records`` with the columns of ``names`` (one row per digest). Records of hot digests are dealt out to parts."""
    hot = F.broadcast(hot)
    dealt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("parts")), F.lit(0)).cast("int")
    left = records.join(hot, "digest", "left").withColumn("_part", dealt).drop("parts")
    copies = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    right = names.join(hot, "digest", "left").withColumn("_part", F.explode(copies)).drop("parts")
    return left.join(right, ["digest", "_part"]).drop("_part")


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> Archive:
    """Write one record per row of ``pages`` below ``path``.

    A null payload is the empty one. Payloads of fewer than ``min_bytes`` bytes are stored once too, but all their records are
    responses. Rows that repeat an id and a payload are records of their own: one is the response, the others revisit its id. Null
    ids come last; if a payload has only those, its revisits refer to a page without an id. A null URL has no header line. An
    empty table gives an empty archive. Two payloads with one SHA-256 that differ in length or SHA-1 are an error.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    whole = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), body.alias("payload"))
    name = F.unhex(F.sha2("payload", 256)).alias("digest")

    facts = stored(
        whole.select("page_id", "url", name, F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha1"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    order = F.struct(F.col("page_id").isNotNull(), "page_id", "row")
    same = (F.min("n") == F.max("n")) & (F.min("sha1") == F.max("sha1"))
    names = stored(
        facts.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(order).alias("last"), same.alias("same"))
        .select(
            "digest",
            "n",
            F.when(F.col("same"), F.col("last.page_id")).otherwise(F.raise_error(F.lit("two payloads have one SHA-256"))).alias("first_id"),
            F.col("last.row").alias("first_row"),
        )
    )
    placed = joined(facts, names.drop("n"), hot_payloads(names.select("digest", "n")))
    revisit = (F.col("row") != F.col("first_row")) & (F.col("n") >= min_bytes)
    text = header_text(F.col("page_id"), F.col("url"), F.col("n"), F.col("sha1"), F.col("first_id"), revisit, date)
    write_parquet(placed.select("page_id", "digest", text.cast("binary").alias("header")), f"{path}/headers")
    write_parquet(whole.groupBy(name).agg(F.first("payload").alias("payload")), f"{path}/payloads")
    return Archive(path, pages.schema[id_column].dataType.simpleString())


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """page_id, header and payload of every record, verified: a payload that does not have its name is an error."""
    held = archive.payloads(spark).select(
        "digest",
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.lit("a stored payload does not have its SHA-256")).cast("binary"))
        .alias("payload"),
    )
    headers = archive.headers(spark)
    hot = hot_payloads(headers.groupBy("digest").agg(F.count("*").alias("n")))
    return joined(headers, held, hot).select("page_id", "header", "payload")


def field(name: str, header: Column | str = "header") -> Column:
    """The value of a line of the WARC header; null if there is none."""
    head = F.substring_index(F.decode(header, "utf-8"), _BREAK * 2, 1)
    value = F.regexp_extract(head, f"\r\n{re.escape(name)}: ([^\r\n]*)", 1)
    return F.nullif(value, F.lit(""))


def index(records: DataFrame) -> DataFrame:
    """payload_bytes, payload_digest, record_type and refers_to of every record read, from its bytes and its header.

    A digest in a header that is not the payload's is an error.
    """
    digest = base32(F.sha1("payload"))
    stated = F.concat(F.lit("sha1:"), digest) == field("WARC-Payload-Digest")
    refers = F.regexp_extract(field("WARC-Refers-To"), "<urn:page:(-?[^>]*)>", 1)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(stated, digest).otherwise(F.raise_error(F.lit("a header states another digest"))).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(refers != "none", refers).cast(records.schema["page_id"].dataType).alias("refers_to"),
    )


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write an archive of ``pages`` to the shared folder, read it back, and give the index of what was read."""
    spark = pages.sparkSession
    return index(read_archive(spark, write_archive(pages, shared_dir(spark), **options)))


def export_files(records: DataFrame, path: str, records_per_file: int = 20_000) -> str:
    """Write records (header, payload) as WARC files: revisits without, responses with their payload."""
    response = field("WARC-Type") == "response"
    record = F.concat(F.col("header"), F.when(response, F.col("payload")).otherwise(F.lit(b"")))
    # the writer of texts puts the bytes as they are; two line breaks end a record
    lines = records.select(record.cast("string").alias("value"))
    lines.write.option("lineSep", _BREAK * 2).option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path)
    return path


def records_in(data: bytes):
    """(header, payload) of the records of a WARC file, by their Content-Length."""
    at = 0
    while at < len(data):
        block = data.index(b"\r\n\r\n", at) + 4
        length = int(re.search(rb"\r\nContent-Length: (\d+)", data[at:block])[1])
        http = data.index(b"\r\n\r\n", block) + 4
        yield data[at:http], data[http : block + length]
        at = block + length + 4


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records (header, payload) of WARC files that ``export_files`` wrote; a file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = T.StructType([T.StructField("header", T.BinaryType()), T.StructField("payload", T.BinaryType())])
    return map_rows(files, schema, lambda: records_in)
