"""Queue messages to ingest batches, and their outcomes back to the messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartfold.contracts import Contract
from chartfold.operators.routing import flatten_notifications, message_outcomes, notification_rejects
from chartfold.plans.ingest import Lake, ingest_batch
from chartfold.sources.landing import Landing
from chartfold.storage import complete, is_complete, write_work_table

OTHER_BUCKET = "OTHER_BUCKET"


def ingest_messages(
    spark: SparkSession,
    messages: DataFrame,
    landing: Landing,
    lake: Lake,
    contract: Contract,
    key: str,
    checkpoint: str,
    bucket: str | None = None,
) -> StreamingQuery:
    """Ingest what a stream of messages ``(receipt, body)`` names, batch by batch, then stop.

    ``acknowledged`` of the lake gets one row per receipt and batch: a message may be deleted
    once all of its objects succeeded. One that cannot be read, or, with ``bucket``, names
    another bucket, may not. A message delivered again gets the outcome its objects had.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        done = acknowledged_folder(lake, batch_id)
        if is_complete(spark, done):
            return
        work = f"{lake.root}/work/messages/batch_id={batch_id}"
        received = write_work_table(rows.select("receipt", "body"), work)
        received = spark.read.schema(received.schema).parquet(work)
        named = flatten_notifications(received)
        foreign = F.lit(False) if bucket is None else F.col("bucket") != bucket
        outcomes = ingest_batch(
            spark, landing, lake, batch_id, contract, key, named.where(~foreign).select("object_key"))
        own = named.where(~foreign).select("receipt", "object_key").distinct()
        files = own.join(outcomes.select("object_key", "status", "error"), "object_key").select(
            "receipt", "object_key", "status", "error")
        strange = named.where(foreign).select(
            "receipt", "object_key", F.lit("failed").alias("status"), F.lit(OTHER_BUCKET).alias("error"))
        unread = notification_rejects(received).select(
            "receipt", F.lit(None).cast("string").alias("object_key"), F.lit("failed").alias("status"),
            F.col("reason").alias("error"))
        every = files.unionByName(strange).unionByName(unread)
        message_outcomes(every).write.mode("overwrite").parquet(done)
        complete(spark, done)

    return (
        messages.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def acknowledged_folder(lake: Lake, batch_id: int) -> str:
    return f"{lake.root}/acknowledged/batch_id={batch_id}"


def read_acknowledged(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = "receipt string, files bigint, failed_files bigint, acknowledge boolean, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{lake.root}/acknowledged")
