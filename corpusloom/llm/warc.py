"""A content-addressed archive of WARC records.

Payload bytes are stored once for each SHA-256 digest; record headers are stored exactly, apart from the payloads,
one for each record; original records come back by joining both on the digest, and are read by parsing their bytes. Of
records with equal payloads of at least ``min_revisit`` bytes the one with the smallest id is the ``response`` and the others
are ``revisit`` records that refer to it; smaller payloads are all responses (and are stored once all the same).

The digest is verified twice: when payloads are stored, all rows of one digest must agree in length and in a second,
independent hash; when they are read back, the digest is computed again. Either failing fails the job, and so does a record
whose bytes don't end where its header says.

Nothing meets in one task but what one digest needs: the smallest id by partial aggregation, and the joins on the
digest are plain equi-joins whose hot keys Spark splits, one payload row against many headers.

A record's own id names the row's id (percent-encoded, so it may hold any characters), its payload and its url.

Defined results: null html is an empty payload; rows that repeat id, url and html are one record given several times, with
one record id; rows that carry the smallest id of a payload are all responses; a null id sorts after all others, and
payloads whose rows all have null ids are all responses. Texts of any length are one payload. Empty tables give empty
archives. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

#: Fixed values of the format.
VERSION, CRLF = "WARC/1.1", "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive lie."""

    headers: str
    payloads: str


def _uri(record_id: Column, digest: Column, target: Column) -> Column:
    name = F.coalesce(F.concat(F.lit("is:"), F.url_encode(record_id.cast("string"))), F.lit("null"))
    return F.concat(F.lit("<urn:record:"), name, F.lit(":"), F.lower(F.substring(F.hex(digest), 1, 16)), F.lit(":"), F.lower(F.hex(target)), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_revisit: int = 100, date: str = "2020-01-01T00:00:00Z") -> Archive:
    """Write one record for every row and return the archive.

    Line breaks in a url are percent-encoded, as header values have none. ``date`` stands in every record, as the
    rows have no date of their own.
    """
    spark = pages.sparkSession
    archive = Archive(scratch_path(spark, "warc-headers"), scratch_path(spark, "warc-payloads"))
    body = F.encode(F.coalesce(F.col(f"`{body_col}`").cast("string"), F.lit("")), "UTF-8")
    url = F.replace(F.replace(F.col(f"`{url_col}`").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    records = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), body.alias("body")).withColumn("digest", F.unhex(F.sha2("body", 256)))

    second = F.xxhash64("body")
    checked = F.when((F.min("size") == F.max("size")) & (F.min("second") == F.max("second")), F.col("digest")).otherwise(F.raise_error(F.lit("two payloads share a SHA-256 digest")))
    slim = records.select("id", "url", "digest", F.octet_length("body").cast("bigint").alias("size"), second.alias("second"), F.xxhash64("url").alias("target"))
    least = (F.min("id").alias("first"), F.min_by("target", "id").alias("first_target"))  # both by hash, if ids are numbers
    firsts = slim.groupBy("digest").agg(*least, checked.alias("checked")).where(F.col("checked").isNotNull()).select("digest", "first", "first_target")

    # each payload once: which of the equal bodies is kept makes no difference
    records.groupBy("digest").agg(F.first("body").alias("body")).write.parquet(archive.payloads)

    told = slim.join(firsts, "digest")
    revisit = F.coalesce((F.col("size") >= min_revisit) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False))
    digest = F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))
    lines = [
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uri(F.col("id"), F.col("digest"), F.col("target"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", digest),
        _line("WARC-Refers-To", F.when(revisit, _uri(F.col("first"), F.col("digest"), F.col("first_target")))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit(CRLF),
    ]
    told.select("id", "digest", revisit.alias("revisit"), F.encode(F.concat(*lines), "UTF-8").alias("header")).write.parquet(archive.headers)
    return archive


def records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record's exact bytes as a WARC file has them, in ``record``: header, block and two line ends; with its ``id`` and
    the ``payload`` that its digest names (a revisit's block is empty)."""
    headers, payloads = spark.read.parquet(archive.headers), spark.read.parquet(archive.payloads)
    both = headers.join(payloads, "digest")
    block = F.when(F.col("revisit"), F.encode(F.lit(""), "UTF-8")).otherwise(F.col("body"))
    return both.select("id", F.concat("header", block, F.encode(F.lit(CRLF * 2), "UTF-8")).alias("record"), F.col("body").alias("payload"), "digest")


def _field(name: str) -> Column:
    """The value of a header line, null if it has none."""
    found = F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record, parsed from its bytes: ``id``, its exact ``header`` and ``block``, the full ``payload`` (a revisit's too), ``digest``
    recomputed from it, and ``record_id``, ``record_type``, ``target``, ``refers_to`` and ``length`` as the header has them."""
    found = records(spark, archive)
    # the header is all up to the first empty line; its text has as many bytes as the record's beginning
    end = F.octet_length(F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)) + 4
    told = found.withColumn("end", end).withColumn("header", F.expr("substring(record, 1, end)")).withColumn("head", F.decode("header", "UTF-8"))
    told = told.withColumn("length", _field("Content-Length").cast("bigint")).withColumn("block", F.expr("substring(record, end + 1, int(length))"))
    whole = F.startswith("head", F.lit(VERSION + CRLF)) & (F.expr("substring(record, int(end + length + 1))") == F.encode(F.lit(CRLF * 2), "UTF-8"))
    told = told.withColumn("block", F.when(whole, F.col("block")).otherwise(F.raise_error(F.lit("a record doesn't end where its header says"))))
    # a response's payload is its own block; a revisit's is the one that its digest names
    payload = F.when(_field("WARC-Type") == "revisit", F.col("payload")).otherwise(F.col("block"))
    named = F.regexp_extract(_field("WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1)
    intact = F.when((F.sha2("payload", 256) == F.col("named")) & (F.unhex("named") == F.col("digest")), F.col("payload")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
    referred = F.regexp_extract(_field("WARC-Refers-To"), "^<urn:record:is:([^:]*):", 1)
    return told.withColumn("payload", payload).withColumn("named", named).select(
        "id",
        "header",
        "block",
        intact.alias("payload"),
        F.col("named").alias("digest"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("target"),
        F.when(_field("WARC-Refers-To").isNotNull(), F.url_decode(referred)).cast(found.schema["id"].dataType).alias("refers_to"),
        "length",
    )


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record's bytes."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split(CRLF)
    if version != VERSION or not mark:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the block has another length than its header says")
    return fields, rest[:size]
