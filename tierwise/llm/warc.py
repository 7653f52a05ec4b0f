"""A content-addressed archive of WARC records.

Payload bytes are stored once under their SHA-256 and length; the exact bytes before a record's
payload, its WARC and HTTP headers, are stored for each record.  A record is the two joined.  The
first record of a payload is a response, others revisit it and have no payload of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.llm.skew import heavy_keys, spread_join

#: Digits of base 32 as ``conv`` writes them, and in the RFC 4648 alphabet.
_PLAIN32, _RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FETCHED = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32; 160 bits are four stretches of 40, so there is no padding."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _PLAIN32, _RFC32)


def _one_line(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]+", " ")


def _header(date: str) -> Column:
    """All bytes of a record before its payload; the HTTP header is part of the WARC block."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    response = F.col("record_type") == "response"
    number = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit("\r\n"),
    )
    block = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", number("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            ~response,
            F.concat(line("WARC-Refers-To", number("refers_to")), line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
    )


def write_archive(pages: DataFrame, folder: str, smallest: int = 0, date: str = FETCHED) -> None:
    """Writes ``pages(page_id, url, html)`` as ``folder/payloads`` and ``folder/headers``.

    The payload is the html in UTF-8, empty if null.  Of records with equal payloads of at least
    ``smallest`` bytes that with the largest page_id is the response; smaller ones are all
    responses, and so is a record without a page_id.  Rows repeated with the largest page_id are
    responses too.  Other columns are not archived.
    """
    records = pages.select(
        F.col("page_id"), F.col("url"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")
    ).select(
        "page_id",
        "url",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    content = ["payload_sha256", "payload_bytes"]
    # Copies collapse before the shuffle; a hot payload is sent once a task.
    records.groupBy(*content).agg(F.any_value("payload").alias("payload")).write.mode("errorifexists").option(
        "compression", "zstd"
    ).parquet(f"{folder}/payloads")
    small = records.drop("payload")
    holders = small.groupBy("payload_sha256").agg(F.max("page_id").alias("_holder"), F.count(F.lit(1)).alias("_n"))
    # Records of a common payload, such as the empty one, are dealt out.
    heavy = heavy_keys(holders, "payload_sha256", "_n")
    joined = spread_join(small, holders.drop("_n"), "payload_sha256", heavy, ["page_id", "url"])
    held = F.col("page_id").isNull() | (F.col("payload_bytes") < smallest) | (F.col("page_id") == F.col("_holder"))
    typed = joined.withColumn("record_type", F.when(held, "response").otherwise("revisit")).withColumn(
        "refers_to", F.when(~held, F.col("_holder"))
    )
    typed.select("page_id", *content, F.encode(_header(date), "utf-8").alias("header")).write.mode(
        "errorifexists"
    ).option("compression", "zstd").parquet(f"{folder}/headers")


def _parsed(name: str) -> Column:
    return F.regexp_extract(F.decode("header", "utf-8"), rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri`` of all records.

    Type, target and reference come from the headers, length and digest from the stored bytes.
    A payload whose SHA-256 is not the one it is stored under, or whose digest is not the one in
    the header, is an error.
    """
    stored = spark.read.parquet(f"{folder}/payloads").select(
        "payload_sha256",
        F.octet_length("payload").cast("long").alias("_bytes"),
        base32_sha1(F.col("payload")).alias("_digest"),
        (F.sha2("payload", 256) == F.col("payload_sha256")).alias("_whole"),
    )
    headers = spark.read.parquet(f"{folder}/headers")
    counts = headers.groupBy("payload_sha256").agg(F.count(F.lit(1)).alias("_n"))
    heavy = heavy_keys(counts, "payload_sha256", "_n")
    joined = spread_join(headers, stored, "payload_sha256", heavy, ["page_id", "header"], "left")
    declared = F.regexp_replace(_parsed("WARC-Payload-Digest"), "^sha1:", "")
    sound = F.coalesce(F.col("_whole") & (F.col("_digest") == declared) & (F.col("_bytes") == F.col("payload_bytes")), F.lit(False))
    checked = F.when(sound, F.col("_digest")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    refers = F.regexp_extract(_parsed("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1)
    kind = headers.schema["page_id"].dataType
    return joined.select(
        "page_id",
        F.col("_bytes").alias("payload_bytes"),
        checked.alias("payload_digest"),
        _parsed("WARC-Type").alias("record_type"),
        F.when(refers != "", refers).cast(kind).alias("refers_to"),
        _parsed("WARC-Target-URI").alias("target_uri"),
    )


def reconstruct(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record``: the exact bytes of each record with the line ends that close it."""
    payloads = spark.read.parquet(f"{folder}/payloads").select(F.col("payload_sha256").alias("_sha"), "payload")
    headers = spark.read.parquet(f"{folder}/headers")
    response = F.when(_parsed("WARC-Type") == "response", F.col("payload_sha256"))
    # Only responses look for a payload, so a hot one is joined once.
    joined = headers.withColumn("_want", response).join(payloads, F.col("_want") == F.col("_sha"), "left")
    end = F.encode(F.lit("\r\n\r\n"), "utf-8")
    return joined.select("page_id", F.concat("header", F.coalesce("payload", F.lit(b"")), end).alias("record"))
