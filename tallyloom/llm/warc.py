"""WARC archives whose payloads are stored once, by content.

An archive is two Parquet tables under one folder: ``payloads`` holds every
distinct payload under its SHA-256, ``headers`` the exact header bytes of every
record (the WARC header block and the HTTP header block) with the address of
its payload. Reading joins the two on the address, checks the payload against
it and gives the original records back byte for byte.

Of records with equal payloads of at least ``least`` bytes, the one with the
largest page_id is a response and the others are revisits that refer to it;
smaller payloads are always responses. Copies of a payload are folded before
they are shuffled, so a frequent payload is one row per task; the rows of
frequent addresses meet their payload in an equi-join that adaptive execution
splits.

Null html counts as empty, a null url leaves its header line out, a null
page_id too and sorts below all others. Rows that repeat a page_id are records
of their own, told apart by ``row``. Other columns are not read. An empty table
gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

NL = "\r\n"
# Fixed values of the WARC 1.1 format
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(NL)), F.lit(""))


def _record_id(page: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least: int = 1000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` (page_id, url, html)."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    base = base.withColumn("address", F.sha2(F.col("payload").cast("binary"), 256))
    base.groupBy("address").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")

    meta = base.select("page_id", "url", "address", F.sha1(F.col("payload").cast("binary")).alias("sha1"), F.octet_length("payload").cast("long").alias("n"), F.monotonically_increasing_id().alias("row"))
    meta = stored(meta, "records")
    wins = meta.where(F.col("n") >= least).groupBy("address").agg(F.max(F.struct("page_id", "row")).alias("win"))
    told = meta.join(wins, "address", "left")
    revisit = F.col("win.row").isNotNull() & (F.col("win.row") != F.col("row"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{NL}Content-Type: text/html; charset=utf-8{NL}Content-Length: "), F.col("n").cast("string"), F.lit(NL + NL))
    body = F.octet_length("http") + F.when(F.col("type") == "response", F.col("n")).otherwise(0)
    head = F.concat(
        F.lit(VERSION + NL),
        _line("WARC-Type", F.col("type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")),
        _line("WARC-Page", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Profile", F.when(F.col("type") == "revisit", F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(F.col("type") == "revisit", _record_id(F.col("win.page_id"), F.col("win.row")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", body.cast("string")),
        F.lit(NL),
    )
    told = told.withColumn("type", F.when(revisit, "revisit").otherwise("response")).withColumn("http", http)
    told.select("row", "address", F.concat(head, "http").alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header, payload (of a revisit, that of the record it refers to) and record (the WARC bytes)."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2(F.col("payload").cast("binary"), 256) == F.col("address")
    checked = payloads.withColumn("payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "address"))))
    own = F.when(F.col("header").contains(f"{NL}WARC-Type: response{NL}"), F.col("payload")).otherwise("")
    return headers.join(checked, "address").select("header", "payload", F.concat("header", own, F.lit(NL + NL)).alias("record"))


def _field(name: str) -> Column:
    """The value of a line of the WARC header block, null if it is absent."""
    return F.nullif(F.regexp_extract("warc", f"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def parsed(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to as the records state them.

    A digest or a length that a record states and its bytes contradict raises an error.
    """
    at = records.withColumn("warc", F.concat(F.substring_index("record", NL + NL, 1), F.lit(NL)))
    at = at.select("record", "warc", "payload", _field("WARC-Type").alias("record_type"), _field("WARC-Page").cast("long").alias("page_id"), _field("WARC-Payload-Digest").alias("stated"), _field("Content-Length").cast("long").alias("length"), F.regexp_extract("warc", "\r\nWARC-Refers-To: <urn:page:(-?[0-9]+):", 1).alias("refers"))
    digest = F.concat(F.lit("sha1:"), F.sha1(F.col("payload").cast("binary")))
    body = F.octet_length("record") - F.octet_length("warc") - 2 - 4  # without the blank line and the closing lines
    sound = (digest == F.col("stated")) & (body == F.col("length"))
    return at.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, F.substring("stated", 6, 40)).otherwise(F.raise_error(F.lit("a record contradicts its payload"))).alias("payload_digest"),
        "record_type",
        F.nullif("refers", F.lit("")).cast("long").alias("refers_to"),
    )
