"""A content-addressed web archive: payload bytes once by digest, exact record headers beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import stored
from ordinate.scratch import scratch_path

#: Payloads below this many bytes are never replaced by a reference.
LEAST = 100

CRLF = "\r\n"


def _header(kind: Column, page: Column, url: Column, digest: Column, size: Column, refers: Column) -> Column:
    """The record's header block as it stands in the archive; a missing field has no line."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    clean = F.regexp_replace(url.cast("string"), r"[\x00-\x1F]", " ")
    return F.concat(
        F.array_join(F.array_compact(F.array(
            F.lit("WARC/1.1"), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))),
            line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">"))),
            F.when(kind == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.lit("Content-Type: text/html"), line("Content-Length", F.when(kind == "response", size).otherwise(F.lit(0))),
            line("X-Payload-Length", size),
        )), CRLF), F.lit(CRLF + CRLF))


def write_archive(
    df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST
) -> None:
    """Write the rows as an archive below ``path``: the table ``payloads`` and the table ``headers``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest key is a response and the
    others are revisits of it; shorter payloads are responses all.  Payloads are the text's UTF-8 bytes (null:
    none); equal digests are checked against length and a second hash, and a collision raises.
    Rows with a null key rank behind all others.  Rows that repeat the smallest key are responses that share its
    payload.  ``payloads`` holds the bytes of each digest once.

    Only keys, digests and sizes are grouped, so a payload that a third of all rows share costs that many
    narrow rows, partly counted before the shuffle.  Payloads move once, to the row that was chosen.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "key", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"),
        F.xxhash64("payload").alias("second"))
    narrow, drop = stored(rows.drop("payload"), "records")
    keys = narrow.groupBy("digest", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high"),
        F.min("second").alias("one"), F.max("second").alias("other"))
    chosen = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), F.col("n").alias("n")))
    firsts = keys.groupBy("digest").agg(
        chosen.alias("c"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("one").alias("one"), F.max("other").alias("other"))
    checked, drop_firsts = stored(firsts.select(
        "digest", F.when((F.col("low") == F.col("high")) & (F.col("one") == F.col("other")), F.col("c"))
        .otherwise(F.raise_error(F.concat(F.lit("different payloads of digest "), F.col("digest")))).alias("c"),
    ).select("digest", F.col("c.key").alias("first"), F.col("c.n").alias("n")), "firsts")
    joined = narrow.join(checked.drop("n").hint("merge"), "digest")
    again = (F.col("size") >= least) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    refers = F.when(again, F.col("first"))
    joined.select(
        "key", "digest", F.encode(_header(kind, F.col("key"), F.col("url"), F.col("digest"), F.col("size"), refers), "UTF-8").alias("header"),
    ).write.parquet(f"{path}/headers")
    one = checked.select(F.col("digest").alias("c_digest"), F.col("first").alias("c_first"), "n")
    bytes_of = rows.select("key", "digest", "payload").join(
        one.hint("merge"), (F.col("digest") == F.col("c_digest")) & F.col("key").eqNullSafe(F.col("c_first")))
    # only rows that repeat the chosen key need a second look; both parts read the same shuffle
    alone = bytes_of.where("n = 1").select("digest", "payload")
    repeated = bytes_of.where("n > 1").select("digest", "payload").dropDuplicates(["digest"])
    alone.unionByName(repeated).write.parquet(f"{path}/payloads")
    drop()
    drop_firsts()


def read_archive(spark, path: str, schema: str = "bigint") -> DataFrame:
    """The archive's records, from its two tables alone.

    :returns: ``(key, record_type, refers_to, payload_bytes, payload_digest, header, payload)``, one row for each record
        written.  Type and reference are read from the header; size and digest are taken from the stored bytes, and
        bytes that do not have their digest raise.  ``payload`` is the full payload, of revisits too.
    """
    headers = spark.read.parquet(f"{path}/headers")
    text = F.decode("header", "UTF-8")

    def field(name: str, pattern: str) -> Column:
        value = F.regexp_extract(text, rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(value != "", value)

    own = F.sha2("payload", 256)
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(own == F.col("digest"), own).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), F.col("digest")))).alias("payload_digest"))
    return headers.join(payloads.hint("merge"), "digest").select(
        "key", field("WARC-Type", "([a-z]+)").alias("record_type"),
        field("WARC-Refers-To", "<urn:page:([^>]*)>").cast(schema).alias("refers_to"),
        "payload_bytes", "payload_digest", "header", "payload")


def archived(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """Write an archive into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, "archive")
    write_archive(df, path, id_col, url_col, payload_col, least)
    return read_archive(spark, path, df.schema[id_col].dataType.simpleString())


def record_bytes(records: DataFrame) -> DataFrame:
    """``(key, record)``: each record as it stands in a WARC file; a revisit has an empty block."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.select("key", F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"))
