"""WARC archives without repeated payloads: revisit records refer to the response that holds their payload.

Everything is built-in functions: a record is text (headers and UTF-8 payload), the two line ends that close a record are
the text sink's line separator, and the marker that opens one is the text source's. So files are written and split by
Spark's own sink and source, on any file system, with no file in a worker's hands.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.operators.scale import broadcast_if_small
from newsgraph.scratch import fresh_path, materialise

# Fixed values of the format.
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are always stored.
MIN_BYTES = 1000


def marker(run: str) -> str:
    """How a record of one run opens: no payload can hold it, since `run` is drawn anew for each archive."""
    return f"WARC/1.1\r\nWARC-Archive-Run: {run}\r\n"


def _record_id(run: str, page: Column, digest: Column) -> Column:
    hexed = F.md5(F.concat_ws(":", F.lit(run), page.cast("string"), digest))
    parts = [F.substring(hexed, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to of every page.

    Only digests and sizes are grouped, combined before the shuffle; of equal payloads of at least `min_bytes` the largest
    page_id is the response, the others refer to it. The groups of two and more are broadcast if few, otherwise the join
    is a shuffle that splits skewed digests. A null html is an empty payload, a null page_id revisits like any other but
    is never referred to; rows that share page_id and payload are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    records = pages.select(
        F.col("page_id"), F.col("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"),
    )
    groups = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND original IS NOT NULL")
        .drop("n")
    )
    joined = records.join(broadcast_if_small(groups), ["payload_digest", "payload_bytes"], "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("original"), F.col("original").isNotNull()), F.col("original"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def write_archives(resolved: DataFrame, path: str, run: str, compression: str = "gzip") -> None:
    """Write one record per row of `resolve`, with fresh headers; one archive file per partition."""
    header = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    none = F.lit(None).cast("string")
    lines = [
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", _record_id(run, F.col("page_id"), F.col("payload_digest"))),
        header("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Target-URI", clean_url),
        header("WARC-Page-ID", F.col("page_id")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        header("WARC-Refers-To", F.when(revisit, _record_id(run, F.col("refers_to"), F.col("payload_digest"))).otherwise(none)),
        header("WARC-Refers-To-Page-ID", F.col("refers_to")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", size),
    ]
    value = F.concat(F.lit(marker(run)), F.concat_ws("", *lines), F.lit("\r\n"), block)
    resolved.select(value.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def read_archives(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The records of one run: record_type, record_id, refers_to_id, page_id, refers_to, target_uri, declared_digest, payload.

    The payload is cut by its declared length in bytes; a revisit record has none (null).
    """
    raw = spark.read.option("lineSep", marker(run)).text(path).where("value <> ''")
    split = raw.select(F.col("value"), F.expr(r"instr(value, '\r\n\r\n')").alias("at")).select(
        F.expr("substring(value, 1, at - 1)").alias("head"), F.expr("substring(value, at + 4)").alias("block")
    )
    field = lambda name: F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    given = lambda name: F.when(F.col("head").contains(f"{name}: "), field(name))
    body = F.expr(r"substring(block, instr(block, '\r\n\r\n') + 4)").cast("binary")
    length = F.regexp_extract(F.expr(r"substring_index(block, '\r\n\r\n', 1)"), r"Content-Length: (\d+)", 1).cast("int")
    return split.select(
        field("WARC-Type").alias("record_type"),
        field("WARC-Record-ID").alias("record_id"),
        given("WARC-Refers-To").alias("refers_to_id"),
        given("WARC-Page-ID").cast("long").alias("page_id"),
        given("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        given("WARC-Target-URI").alias("target_uri"),
        F.regexp_extract("head", r"WARC-Payload-Digest: sha1:([0-9a-f]*)", 1).alias("declared_digest"),
        F.when(field("WARC-Type") == "response", F.substring(body, F.lit(1), length)).alias("payload"),
    )


def deduplicated(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write `pages` as archives below `path` (default: a fresh shared folder), read them back, resolve the revisits.

    page_id, payload_bytes, payload_digest (both computed from the payload that was read; a revisit takes those of the
    response it refers to), record_type, refers_to. Empty tables give an empty archive and no rows.
    """
    spark, run = pages.sparkSession, uuid.uuid4().hex
    path = path or fresh_path(spark, "warc")
    write_archives(resolve(pages, min_bytes), path, run)
    records = materialise(
        read_archives(spark, path, run).select(
            "record_type", "record_id", "refers_to_id", "page_id", "refers_to",
            F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        ),
        "warc-records",
    )
    responses = records.where("record_type = 'response'")
    originals = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(originals, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))
