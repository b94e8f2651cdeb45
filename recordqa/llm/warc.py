"""Content-addressed WARC archive.

Payload bytes are stored once per strong digest (SHA-256, checked again on reading); exact
record headers are kept apart, one row per record; original records come back by a join.
Everything is Spark SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordqa.llm.common import text_or_empty, work_dir

CRLF = "\r\n"
#: Fixed value: the profile WARC 1.1 names for revisits with an equal payload digest.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value: the alphabet of RFC 4648 base32, and the digits Spark's ``conv`` writes in base 32.
BASE32, CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_of_hex(digest: Column, n_hex: int = 40) -> Column:
    """Upper-case base32 without padding, of a hex text whose length is a multiple of 5."""
    groups = [
        F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, n_hex + 1, 5)
    ]
    return F.translate(F.concat(*groups), CONV32, BASE32)


@dataclass(frozen=True)
class Archive:
    """Folders of one archive: record headers and payload bytes."""

    headers: str
    payloads: str


def write_archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 0,
    path: str | None = None,
) -> Archive:
    """Writes one WARC record per row into an archive and returns its folders.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    largest id is a response and the others are revisits that refer to it; smaller payloads
    are responses all. A null or empty html is the empty payload. Rows with one id and one
    payload (repeated rows) are one response and revisits to themselves would say nothing,
    so they all are responses; a null id counts as the smallest and is written as ``null``.
    A null url gives an empty target. No rows make an archive without records.

    Only digests and ids are grouped and joined, so a payload that a third of all pages share
    costs a row per task. Payload bytes move once, spread by id, to the rows that hold them.
    """
    spark = pages.sparkSession
    root = path or work_dir(spark, "warc")
    payload = F.encode(text_or_empty(html_col), "UTF-8")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).select(
        "id", "url", "payload", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("key"),
        F.sha1("payload").alias("sha1"),
    )
    narrow = rows.select("id", "url", "n_bytes", "key", "sha1")
    first = narrow.groupBy("key").agg(F.max("id").alias("origin"), F.count(F.lit(1)).alias("copies"))
    repeats = (F.col("n_bytes") >= min_revisit_bytes) & F.col("origin").isNotNull() & ~F.col("id").eqNullSafe(F.col("origin"))
    known = narrow.join(first, "key")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))
    field = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        field("WARC-Type", F.when(repeats, "revisit").otherwise("response")),
        field("WARC-Record-ID", name(F.col("id"))),
        field("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")),
        field("WARC-Payload-Digest", digest),
        F.when(
            repeats,
            F.concat(field("WARC-Profile", F.lit(REVISIT)), field("WARC-Refers-To", name(F.col("origin")))),
        ).otherwise(F.lit("")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(repeats, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit(CRLF),
    )
    headers = known.select("id", "key", F.encode(header, "UTF-8").alias("header"))
    headers.write.parquet(f"{root}/headers")
    # The row that stores a payload: one per digest, the first of those with the largest id.
    # Rows that cannot be it (their digest is another row's) drop out after the id join.
    # A join on (id, key) leaves repeated rows side by side, so they fold without another shuffle.
    ident = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("ident")
    stored = (
        rows.select(ident("id"), "key", "payload")
        .join(first.select(ident("origin"), "key"), ["ident", "key"], "left_semi")
        .dropDuplicates(["ident", "key"])
    )
    stored.select("key", "payload").write.parquet(f"{root}/payloads")
    return Archive(f"{root}/headers", f"{root}/payloads")


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract(F.col("head"), f"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def read_headers(spark: SparkSession, archive: Archive) -> DataFrame:
    """Parsed headers: id, key, header, record_type, url, digest, refers_to, block_bytes."""
    ident = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    parsed = spark.read.parquet(archive.headers).withColumn("head", F.decode("header", "UTF-8"))
    return parsed.select(
        ident(_field("WARC-Record-ID")).alias("id"),
        "key",
        "header",
        _field("WARC-Type").alias("record_type"),
        F.coalesce(_field("WARC-Target-URI"), F.lit("")).alias("url"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("digest"),
        ident(_field("WARC-Refers-To")).alias("refers_to"),
        _field("Content-Length").cast("long").alias("block_bytes"),
    )


def verified_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """key, payload, payload_bytes, payload_sha1 of stored bytes; fails where bytes and key differ."""
    stored = spark.read.parquet(archive.payloads)
    same = F.sha2("payload", 256) == F.col("key")
    return stored.select(
        F.when(same, F.col("key")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "key"))).alias("key"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )


def read_records(spark: SparkSession, archive: Archive, with_bytes: bool = False) -> DataFrame:
    """Every record of the archive, its payload found by digest, revisits included.

    id (text), record_type, url, refers_to, payload_bytes, payload_digest; with
    ``with_bytes`` also ``payload`` and ``record``, the exact bytes of the WARC record. The digest in the header must
    be that of the stored bytes. Without bytes the join carries lengths and digests only.
    """
    store = verified_payloads(spark, archive)
    joined = read_headers(spark, archive).join(store if with_bytes else store.drop("payload"), "key")
    agreed = F.when(F.col("digest") == F.col("payload_digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("header and payload differ: "), "id"))
    )
    block = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload")) if with_bytes else None
    more = [F.col("payload"), F.concat("header", block, F.encode(F.lit(CRLF * 2), "UTF-8")).alias("record")] if with_bytes else []
    return joined.select("id", "record_type", "url", "refers_to", "payload_bytes", agreed.alias("payload_digest"), *more)
