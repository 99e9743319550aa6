"""WARC archive (operator 2): payload bytes stored once by digest, record headers apart, records rebuilt by joins.

An archive is a folder of two Parquet tables. ``payloads`` has each distinct payload under its SHA-256 and length;
``headers`` has the exact header block of every record with the digest of what follows it. A later record with the
payload of another is a ``revisit`` that refers to it and has no block of its own. Digests are verified: no two payloads of
one digest may differ in a second, independent hash, and what is read back must hash to its key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load
from tablesync.session import scratch_dir

#: Payloads of fewer bytes are never revisits.
MIN_SHARED = 1000
_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    path: str

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"

    @property
    def headers(self) -> str:
        return f"{self.path}/headers"


def _header(kind: Column) -> Column:
    """The header block of a record, with the empty line that ends it."""
    revisit = kind == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(_DATE)),
        # A line break in a URL would end the header: it is escaped.
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id"), F.lit(">"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))), F.lit("\r\n"),
    ).cast("binary")


def write_archive(pages: DataFrame, path: str, min_shared: int = MIN_SHARED) -> Archive:
    """Archive every row of ``pages`` (``page_id``, ``url``, ``html``; others are not read).

    Of equal payloads of at least ``min_shared`` bytes the one with the largest id is the response. A null page is an empty
    payload, a null id stays null and is never the largest if there is another, a repeated row is a record of its own with the
    same type as the first.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string"), html.alias("payload")
    ).withColumns({
        "bytes": F.octet_length("payload").cast("bigint"), "sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"),
    })
    slim = rows.select("page_id", "url", "bytes", "sha256", "sha1", F.xxhash64("payload").alias("second"))
    groups = slim.groupBy("sha256").agg(
        F.max("page_id").alias("first_id"), F.min("second").alias("low"), F.max("second").alias("high"),
        F.min("bytes").alias("least"), F.max("bytes").alias("most"),
    ).select(
        "sha256",
        F.when((F.col("low") == F.col("high")) & (F.col("least") == F.col("most")), F.col("first_id"))
        .otherwise(F.raise_error(F.lit("payloads of one digest differ")).cast("bigint")).alias("first_id"),
    )
    kind = F.when((F.col("bytes") >= min_shared) & ~F.col("page_id").eqNullSafe(F.col("first_id")), "revisit").otherwise("response")
    archive = Archive(path)
    slim.join(groups, "sha256").withColumn("kind", kind).select(
        "page_id", _header(F.col("kind")).alias("header"), "sha256"
    ).write.parquet(archive.headers)
    # Once per digest: whoever holds a digest first writes it. Only payloads move here, each only within its digest.
    rows.groupBy("sha256", "bytes").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(archive.payloads)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record, rebuilt: ``header`` and ``record`` (its exact bytes), with the fields of the header.

    ``payload`` is the full payload, of revisits too. Columns that are not used are not read: without ``record`` and
    ``payload`` the payload bytes stay where they are hashed. A payload that does not hash to its key is an error.
    """
    stored = spark.read.parquet(archive.payloads)
    true = F.sha2("payload", 256) == F.col("sha256")
    stored = stored.select(
        "sha256", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(true, F.sha1("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest"))).alias("payload_digest"),
    )
    field = lambda name: F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    page = lambda name: F.regexp_extract(field(name), r"^<urn:page:(-?[0-9]+)>$", 1)
    joined = spark.read.parquet(archive.headers).join(stored, "sha256")
    revisit = field("WARC-Type") == "revisit"
    return joined.select(
        F.nullif(page("WARC-Record-ID"), F.lit("")).cast("bigint").alias("page_id"), "header",
        F.concat("header", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")), F.lit(b"\r\n\r\n")).alias("record"),
        "payload", "payload_bytes", "payload_digest", field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        F.try_to_number(page("WARC-Refers-To"), F.lit("S9999999999999999999")).cast("bigint").alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
    )


def export_warc(spark: SparkSession, archive: Archive, folder: str, files: int = 1) -> None:
    """WARC files of the archive's records: Spark's text writer with the two line ends that close a record between them."""
    record = F.expr("substring(record, 1, octet_length(record) - 4)")
    read_archive(spark, archive).select(record.cast("string").alias("value")).repartition(files).write.option(
        "lineSep", "\r\n\r\n"
    ).text(folder)


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(load(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
                  CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
     f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
