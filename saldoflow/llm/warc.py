"""Content-addressed WARC archive.

An archive is a folder with two tables. ``payloads`` holds the bytes of each distinct payload once,
under its SHA-256; ``records`` holds the exact header text of every record and the digest of its
payload. A record is rebuilt by joining both, and the payload is hashed again on the way: a payload
that doesn't match its address, or a record whose payload is missing, is an error.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the largest
``page_id`` is the response and the others revisit it. Smaller ones are all responses. A null html
is an empty payload; a null url leaves its header line out; rows with a null ``page_id`` revisit if
a numbered page has their payload, and are responses otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

REVISIT_BYTES = 1000
LINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line, or NULL (which concat_ws leaves out) for a NULL value."""
    return F.concat(F.lit(f"{name}: "), value)


def _http_head(size: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
                    size.cast("string"), F.lit(LINE + LINE))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(captured: str) -> Column:
    """WARC header lines and HTTP head of a record; line ends in an url are percent-encoded."""
    revisit = F.col("record_type") == "revisit"
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = _http_head(F.col("payload_bytes"))
    block = F.length(head) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    lines = F.concat_ws(
        LINE, F.lit("WARC/1.1"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))), _line("WARC-Date", F.lit(captured)),
        _line("WARC-Target-URI", url), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, _line("WARC-Refers-To", _urn(F.col("refers_to")))),
        F.when(revisit, _line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")))
    return F.concat(lines, F.lit(LINE + LINE), head)


def write_archive(pages: DataFrame, folder: str, captured: str = "1970-01-01T00:00:00Z") -> None:
    """Writes one record per row of ``pages`` (``page_id``, ``url``, ``html``) to ``folder``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", "url", payload.alias("payload"),
                         F.unhex(F.sha2(payload, 256)).alias("digest"))
    named.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{folder}/payloads")

    heads = stored(named.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"),
                                F.length("payload").cast("bigint").alias("payload_bytes")))
    holders = heads.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("holder"))
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    typed = join_splittable(heads, holders, ["digest"]).select(
        "*", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("holder")).alias("refers_to"))
    typed.select("digest", _header(captured).alias("header")).write.parquet(f"{folder}/records")


def _field(name: str, pattern: str = "([^\r]*)") -> Column:
    found = F.regexp_extract("header", rf"(?:^|\n){name}: {pattern}\r", 1)
    return F.when(F.col("header").rlike(rf"(?:^|\n){name}: "), found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive, verified.

    Returns ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_bytes`` and
    ``payload_digest`` (of the payload as stored; a revisit has the payload it refers to),
    ``header`` (exact text up to the payload) and ``payload``. ``record_bytes`` gives the bytes.
    """
    address = F.unhex(F.sha2("payload", 256))
    checked = F.when(address == F.col("digest"), F.sha1("payload")).otherwise(
        F.raise_error(F.lit("a payload doesn't match its digest")))
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "digest", "payload", checked.alias("found_sha1"),
        F.length("payload").cast("bigint").alias("payload_bytes"))
    records = spark.read.parquet(f"{folder}/records")
    whole = F.when(F.col("found_sha1") == _field("WARC-Payload-Digest", "sha1:([0-9a-f]*)"), F.col("found_sha1"))
    return join_splittable(records, payloads, ["digest"]).select(
        _field("WARC-Record-ID", "<urn:page:([^>]*)>").try_cast("bigint").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Refers-To", "<urn:page:([^>]*)>").try_cast("bigint").alias("refers_to"),
        "payload_bytes",
        F.coalesce(whole, F.raise_error(F.lit("a record's payload is missing or another one"))).alias("payload_digest"),
        "header", "payload")


def record_bytes(records: DataFrame) -> DataFrame:
    """The records of ``read_archive`` with ``record``, the bytes of the WARC record."""
    none = F.lit("").cast("binary")
    body = F.when(F.col("record_type") == "revisit", none).otherwise(F.col("payload"))
    return records.withColumn(
        "record", F.concat(F.col("header").cast("binary"), body, F.lit(LINE + LINE).cast("binary")))
