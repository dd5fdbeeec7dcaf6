"""Content-addressed web archive: payloads stored once, record headers apart.

``write_archive`` keeps two tables in a folder. ``payloads`` has the bytes of
each different payload under its SHA-256, and rows that share a digest are
compared byte by byte before they share an address. ``records`` has the exact
header text of every record with the address of its payload. ``read_archive``
joins them to whole records again and checks that length and digests still fit.

Of the records whose payloads are equal and at least ``min_bytes`` long, the one
with the largest id is a response and the others are revisits that name it;
smaller payloads are all responses. Rows that share the largest id are all
responses. A null payload is an empty one; a null URL leaves the header field
empty; line breaks in a URL are percent-encoded so that they end no header.
A record without an id has an empty one, and is a response only where no row of
its group has one. An empty table gives an empty archive. Columns other than the
three named ones are not archived. Payloads of any length are kept whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.llm.common import equal_texts, text_or_empty

_END = "\r\n"


def _address(text):
    return F.unhex(F.sha2(text, 256))


def header(date: str):
    """Header text of a record, ended by an empty line."""
    field = lambda name, value: F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit(_END))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("record_type") == "revisit"
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return F.concat(
        F.lit(f"WARC/1.1{_END}"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", page("id")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(profile)), field("WARC-Refers-To", page("keep")))).otherwise(""),
        field("Content-Length", F.col("size")),
        F.lit(_END),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``payloads`` and ``records`` below ``path``, which must not exist yet."""
    spark = pages.sparkSession
    stored = equal_texts(pages, id_col, payload_col, _address).select(
        F.col("h").alias("address"),
        F.encode("text", "UTF-8").alias("payload"),
        F.octet_length("text").cast("long").alias("size"),
        F.sha1("text").alias("sha1"),
        F.col("n"),
        F.col("keep"),
    )
    stored.write.parquet(f"{path}/payloads")
    stored = spark.read.parquet(f"{path}/payloads").select("address", "size", "sha1", "n", "keep")
    # Two payloads under one SHA-256 were kept apart above; an address must mean one of them.
    if not stored.groupBy("address").count().filter("count > 1").isEmpty():
        raise ValueError("different payloads share a SHA-256 digest")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(payload_col).alias("text"))
    rows = rows.select("id", "url", _address(F.col("text")).alias("address")).join(stored, "address")
    revisit = (F.col("size") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("keep"))
    rows = rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    rows.select("id", F.encode(header(date), "UTF-8").alias("header"), "address").write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: ``id, header, payload, record`` and what the header says.

    ``record`` is the record's bytes as an archive file holds them: the header,
    the payload (of a revisit: nothing) and two line ends. ``payload`` is the full
    one for revisits too. A payload that no longer fits its address, or the digest
    and length in its header, fails the read.
    """
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    checked = payloads.select(
        "address",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.sha2("payload", 256).alias("found"),
    )
    text = F.decode("header", "UTF-8")
    said = lambda pattern: F.regexp_extract(text, rf"\r\n{pattern}\r\n", 1)
    joined = records.join(checked, "address").withColumns(
        {
            "record_type": said("WARC-Type: ([a-z]+)"),
            "said_digest": said("WARC-Payload-Digest: sha1:([0-9a-f]+)"),
            "said_bytes": said("Content-Length: ([0-9]+)").try_cast("long"),
        }
    )
    fits = F.lower(F.hex("address")) == F.col("found")
    agrees = F.col("said_digest").eqNullSafe(F.col("payload_digest")) & F.col("said_bytes").eqNullSafe(F.col("payload_bytes"))
    # In both, so that a reader of either column has it checked.
    sure = {
        c: F.when(~fits, F.raise_error("a payload does not fit its address"))
        .when(~agrees, F.raise_error("a payload does not fit its header"))
        .otherwise(F.col(c))
        for c in ("payload", "payload_digest")
    }
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.withColumns(sure).select(
        "id",
        "header",
        "payload",
        F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        said("WARC-Target-URI: ([^\r\n]*)").alias("url"),
        said("WARC-Refers-To: <urn:page:(-?[0-9]+)>").try_cast("long").alias("refers_to"),
        "said_digest",
        "said_bytes",
    )
