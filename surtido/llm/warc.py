"""WARC archives: revisit resolution by payload digest, writing, reading back.

An archive is a folder of gzip files that Spark's text source writes and reads. All records
of an archive name the same random warcinfo record in their first header field, so the end
of one record and the start of the next make a separator no payload holds, and files are
read record by record, never whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.llm.common import stored

VERSION = "WARC/1.1"
END = "\r\n\r\n"
# Payloads below this many bytes are always stored.
LEAST_REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"


def _opening(archive: str) -> str:
    return f"{VERSION}\r\nWARC-Warcinfo-ID: <urn:uuid:{archive}>\r\n"


def _record_id(archive: str, *parts: Column) -> Column:
    """A name-based URN from the archive and what identifies the row in it."""
    digest = F.sha2(F.concat_ws("/", F.lit(archive), *[
        F.coalesce(p.cast("string"), F.lit("null")) for p in parts]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, digest: the input of an archive.

    A null payload counts as empty; a null URL becomes ``urn:unknown``; line ends in a URL
    are percent-encoded, as a header field has one line.
    """
    rows = pages.select(F.col(id_col).alias("page_id"),
                        F.coalesce(F.col(url_col), F.lit("urn:unknown")).alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return rows.withColumns({
        "url": url, "payload_bytes": F.octet_length("payload").cast("long"),
        "digest": F.sha2(F.col("payload").cast("binary"), 256)})


def originals(rows: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(digest, first, first_url) of the payloads that several records hold.

    Only headers move, and copies within a task are one row before they do.
    """
    return rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"),
        F.min_by("url", F.struct("page_id", "url")).alias("first_url"),
        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def write(rows: DataFrame, folder: str, archive: str,
          least_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """Write a record per row: a response, or a revisit of the smallest page_id's response.

    Of rows with equal payloads of at least ``least_bytes`` those with the smallest page_id
    are responses. Rows without a page_id are responses only if no row of the payload has
    one. Revisit records carry fresh headers and no payload.
    """
    # A payload is as wide as its page, so the rows go to their originals in one shuffle. The
    # originals are written first: a join of two plain tables splits a payload of many pages.
    joined = rows.join(stored(originals(rows, least_bytes)), "digest", "left")
    revisit = F.col("first").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    joined = joined.withColumn("revisit", revisit).withColumn(
        "body", F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    http = F.concat(F.lit(_HTTP), F.lit("\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    refers = F.when(F.col("revisit"), F.concat(
        F.lit("\r\nWARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: "),
        _record_id(archive, F.col("first"), F.col("digest")),
        F.lit("\r\nWARC-Refers-To-Target-URI: "), "first_url")).otherwise(F.lit(""))
    page = F.coalesce(F.concat(F.lit("\r\nX-Page-ID: "), F.col("page_id").cast("string")),
                      F.lit(""))
    record = F.concat(
        F.lit(_opening(archive)), F.lit("WARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(archive, F.col("page_id"), F.col("digest")),
        F.lit("\r\nWARC-Date: "), now, F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"), refers, page,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length("body")).cast("string"), F.lit(END), http, "body")
    joined.select(record.alias("value")).write.option("lineSep", END).option(
        "compression", "gzip").text(folder)


def read(spark: SparkSession, folder: str, archive: str, page_type: str = "bigint") -> DataFrame:
    """The records of an archive: header fields, and the payload of the responses.

    A record shorter than its Content-Length stops the job.
    """
    opening = _opening(archive)
    rows = spark.read.option("lineSep", END + opening).text(folder)
    value = F.when(F.startswith("value", F.lit(opening)),
                   F.substring("value", len(opening) + 1, 2**31 - 1)).otherwise(F.col("value"))
    rows = rows.select(value.alias("value")).withColumn(
        "head", F.substring_index("value", END, 1))
    rows = rows.select(
        F.str_to_map("head", F.lit("\r\n"), F.lit(": ")).alias("field"),
        F.col("value").cast("binary").alias("raw"),
        (F.octet_length("head") + len(END)).alias("skip"))
    length = F.col("field")["Content-Length"].cast("int")
    whole = F.octet_length("raw") >= F.col("skip") + length
    block = F.when(whole, F.expr("substring(raw, skip + 1, int(field['Content-Length']))")
                   ).otherwise(F.raise_error(F.lit("a WARC record is cut short")))
    rows = rows.select("field", block.alias("block"))
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    rows = rows.select("field", "block", (F.octet_length(http) + len(END)).alias("skip"))
    return rows.select(
        F.try_element_at("field", F.lit("X-Page-ID")).cast(page_type).alias("page_id"),
        F.col("field")["WARC-Record-ID"].alias("record_id"),
        F.col("field")["WARC-Type"].alias("record_type"),
        F.try_element_at("field", F.lit("WARC-Refers-To")).alias("refers"),
        F.replace(F.col("field")["WARC-Payload-Digest"], F.lit("sha256:"),
                  F.lit("")).alias("digest"),
        F.when(F.col("field")["WARC-Type"] == "response", F.expr(
            "substring(block, skip + 1, octet_length(block))")).alias("payload"))


def resolve(records: DataFrame) -> DataFrame:
    """One row per record, a revisit with the size and digest of the response it names.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; size and digest are
    taken from the stored payload. Payloads stay where they are, headers are joined.
    """
    heads = stored(records.select(
        "page_id", "record_id", "record_type", "refers", "digest",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2("payload", 256).alias("own")))
    target = heads.where("record_type = 'response'").groupBy("record_id").agg(
        F.min("page_id").alias("to_page"), F.first("bytes").alias("to_bytes"),
        F.first("own").alias("to_digest"))
    joined = heads.join(stored(target.withColumnRenamed("record_id", "refers")), "refers", "left")
    return joined.select(
        "page_id", F.coalesce("bytes", "to_bytes").alias("payload_bytes"),
        F.coalesce("own", "to_digest").alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("to_page")).alias("refers_to"))


def archive_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html",
                  least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write the pages as a deduplicated archive and read it back, one row per page.

    A null html counts as empty and is a response; repeated rows are records of their own,
    all responses if their page_id is the smallest of the payload; an empty table gives an
    empty archive; other columns are left out.
    """
    spark, archive = pages.sparkSession, str(uuid.uuid4())
    rows = payloads(pages, id_col, url_col, html_col)
    write(rows, folder, archive, least_bytes)
    kind = rows.schema["page_id"].dataType.simpleString()
    return resolve(read(spark, folder, archive, kind))
