"""Clinical views over the general test tables, and the key the tests hash with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.functions.privacy import pseudonymize_hmac
from chartfold.session import hide_secrets

FIXTURE_KEY = "fixture-key"  # for test tables only; real keys come from load_key()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    hide_secrets(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_batch(moment: Column | str = "ingested_at") -> Column:
    return F.to_date(moment)


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing vitals with a clear patient id: one reading per event."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("encounter_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("patient_id"),
        F.round("value").cast("bigint").alias("heart_rate"),
        F.get_json_object("props", "$.k").alias("blood_pressure"),
        F.col("value").alias("temperature"),
        F.col("event_type").alias("source_vendor"),
        F.concat(F.lit("f"), F.date_format("ts", "yyyyMMdd")).alias("lineage_file_uuid"),
        F.col("ts").alias("ingested_at"),
    )


def staged_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as a staging table, pseudonymised."""
    return vitals(spark, sf_dir).select(
        "encounter_id",
        pseudonymize_hmac("patient_id", FIXTURE_KEY).alias("hashed_patient_id"),
        "heart_rate",
        "blood_pressure",
        "temperature",
        "source_vendor",
        "lineage_file_uuid",
        "ingested_at",
    )


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing enrollments with gaps in patient id and grade."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("encounter_id"),
        F.when(key % 11 == 0, "")
        .when(key % 13 == 0, "  ")
        .otherwise(F.concat(F.lit("P"), F.col("o_custkey").cast("string")))
        .alias("patient_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("enrollment_date"),
        F.when(key % 7 == 0, "").otherwise((key % 400).cast("string")).alias("gpa"),
        F.concat(F.lit("vendor_"), F.col("o_orderstatus")).alias("source_vendor"),
        F.col("o_orderdate").alias("landed_on"),
        key.alias("row_number"),
    )
