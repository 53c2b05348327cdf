"""Notifications to file tasks, and file outcomes back to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.functions.paths import decode_key, is_xml
from chartfold.functions.text import as_column

BULK_BYTES = 50 * 1024 * 1024  # fixed value: from this size on, a file takes the bulk lane

_BODY = (
    "Records array<struct<s3: struct<bucket: struct<name: string>,"
    " object: struct<key: string, size: bigint>>>>, _malformed string"
)


def parsed_body(body: Column | str = "body") -> Column:
    """Message body as a struct, with the text in ``_malformed`` if it is no JSON object."""
    return F.from_json(as_column(body), _BODY, {"columnNameOfCorruptRecord": "_malformed"})


def flatten_notifications(messages: DataFrame) -> DataFrame:
    """One row per object named in a message; a message without records gives none.

    The outer form of explode keeps Spark from testing the records for emptiness first,
    for which it would parse every body twice.
    """
    records = messages.select(
        "receipt", F.explode_outer(parsed_body().getField("Records").getField("s3")).alias("s3")
    )
    return records.select(
        "receipt",
        F.col("s3.bucket.name").alias("bucket"),
        decode_key("s3.object.key").alias("object_key"),
        F.col("s3.object.size").alias("object_size"),
    ).where("bucket is not null and object_key is not null and object_size is not null")


def _is_broken(parsed: Column) -> Column:
    incomplete = F.exists(
        F.coalesce(parsed["Records"], F.array()),
        lambda r: r.isNull()
        | r["s3"]["bucket"]["name"].isNull()
        | r["s3"]["object"]["size"].isNull()
        | decode_key(r["s3"]["object"]["key"]).isNull(),
    )
    return parsed.isNull() | parsed["_malformed"].isNotNull() | incomplete


def notification_rejects(messages: DataFrame) -> DataFrame:
    """Messages that are no JSON object, or that name an object incompletely."""
    # As the element of an array, the body is parsed once for all tests on it.
    broken = F.exists(F.array(parsed_body()), _is_broken)
    return messages.where(broken).select("receipt", "body", F.lit("MALFORMED").alias("reason"))


def lane(size: Column | str, key: Column | str, bulk_bytes: int = BULK_BYTES) -> Column:
    is_bulk = (as_column(size) >= bulk_bytes) | is_xml(key)
    return F.when(is_bulk, "bulk").otherwise("small")


def route_files(
    objects: DataFrame,
    size: str = "object_size",
    key: str = "object_key",
    bulk_bytes: int = BULK_BYTES,
) -> DataFrame:
    return objects.withColumn("lane", lane(size, key, bulk_bytes))


def message_outcomes(outcomes: DataFrame) -> DataFrame:
    """Per receipt: may the message be acknowledged? Only once all of its files succeeded."""
    success = F.col("status") == "success"
    return outcomes.groupBy("receipt").agg(
        F.count("*").alias("files"),
        F.count_if(~success).alias("failed_files"),
        F.bool_and(success).alias("acknowledge"),
    )
