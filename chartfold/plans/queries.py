"""Registered queries: every operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.contracts import ENROLLMENT, VITALS
from chartfold.functions import paths
from chartfold.functions.privacy import (
    clear_identities,
    pseudonymize_concat,
    pseudonymize_hmac,
    surrogate_key,
    timestamp_text,
)
from chartfold.operators import cleaning, history, quality, routing
from chartfold.plans.views import (
    FIXTURE_KEY,
    day_batch,
    enrollment,
    staged_vitals,
    table,
    vitals,
)

AS_OF = "2024-01-15 12:00:00"
FIRST_CUT = "2024-01-01 12:00:00"  # by then only some users have a reading
ROUTE_BYTES = 5000


def q_pseudonymize_hmac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", pseudonymize_hmac("c_name", FIXTURE_KEY).alias("hashed_id")
    )


def q_pseudonymize_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", pseudonymize_concat("c_name", FIXTURE_KEY).alias("hashed_id")
    )


def q_clear_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many clear ids survive in the clear table, and how many in the cleaned one."""
    landed = enrollment(spark, sf_dir)
    ids = cleaning.required_keys(landed, ["patient_id"]).select(F.col("patient_id").alias("identity"))
    lineage = landed.withColumn("lineage_file_uuid", F.lit(paths.UNKNOWN_UUID))
    cleaned = cleaning.clean_rows(lineage, ENROLLMENT, FIXTURE_KEY)
    counts = [
        clear_identities(df, ids).agg(F.count("*").alias("leaked")).select(F.lit(name).alias("side"), "leaked")
        for name, df in (("landing", landed), ("silver", cleaned))
    ]
    return counts[0].unionByName(counts[1])


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vitals(spark, sf_dir).select(
        "encounter_id",
        timestamp_text("ingested_at").alias("loaded"),
        surrogate_key("encounter_id", "source_vendor", "ingested_at").alias("vitals_hash_key"),
    )


def q_required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.required_keys(enrollment(spark, sf_dir), ENROLLMENT.non_blank)
    return rows.select("encounter_id", "patient_id", "gpa")


def q_required_keys_null_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrollment(spark, sf_dir).withColumn(
        "patient_id", F.when(F.col("patient_id") != "", F.col("patient_id"))
    )
    rows = cleaning.required_keys(rows, ENROLLMENT.non_blank, blank_counts_as_missing=False)
    return rows.select("encounter_id", "patient_id")


def q_default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.fill_defaults(enrollment(spark, sf_dir), ENROLLMENT)
    return rows.select("encounter_id", "gpa")


def q_trim_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_number")
    padded = enrollment(spark, sf_dir).withColumn(
        "enrollment_date",
        F.concat(
            F.when(key % 2 == 0, "　 ").otherwise("\t"),
            F.col("enrollment_date"),
            F.when(key % 3 == 0, " \n").otherwise(""),
        ),
    )
    return cleaning.trim_columns(padded, ["enrollment_date"]).select("encounter_id", "enrollment_date")


def q_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("row_number")
    marked = enrollment(spark, sf_dir).withColumn(
        "gpa",
        F.when(key % 5 == 0, "NULL")
        .when(key % 5 == 1, "NONE")
        .when(key % 5 == 2, "none")
        .otherwise(F.col("gpa")),
    )
    return cleaning.nullify_tokens(marked, ["gpa"]).select("encounter_id", "gpa")


def q_drop_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrollment(spark, sf_dir).withColumns(
        {
            "hashed_patient_id": pseudonymize_hmac("patient_id", FIXTURE_KEY),
            "lineage_file_uuid": F.lit(paths.UNKNOWN_UUID),
        }
    )
    return cleaning.drop_identity(rows, ENROLLMENT, extras=("landed_on",))


def q_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required keys, strip, default, pseudonym and the six silver columns in one pass."""
    landed = enrollment(spark, sf_dir).withColumn(
        "lineage_file_uuid", F.date_format("landed_on", "yyyyMM")
    )
    rows = cleaning.clean_rows(landed, ENROLLMENT, FIXTURE_KEY)
    return quality.reject_empty_files(rows).select(*ENROLLMENT.silver_columns)


def q_typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("value").cast("decimal(18,2)").cast("string")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("encounter_id"),
        F.when(F.col("event_id") % 10 == 0, F.concat(text, F.lit(" bpm"))).otherwise(text).alias("heart_rate"),
        text.alias("temperature"),
    )
    typed = cleaning.typed_columns(rows, VITALS)
    return typed.select(
        "encounter_id",
        "heart_rate",
        "temperature",
        "source_vendor",
        F.array_join("cast_errors", ",").alias("cast_errors"),
    )


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of several shapes, from suppliers and their nations."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    vendor = F.lower(F.replace("n_name", F.lit(" "), F.lit("_")))
    stem = F.concat(vendor, F.lit("__vitals__20260614__u"), F.col("s_suppkey").cast("string"))
    shape = F.col("s_suppkey") % 6
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).select(
        "s_suppkey",
        F.concat(
            vendor,
            F.lit("/"),
            F.when(shape == 0, F.concat(stem, F.lit(".csv")))
            .when(shape == 1, F.concat(stem, F.lit(".CSV")))
            .when(shape == 2, F.concat(F.lit("a__"), stem, F.lit(".csv")))
            .when(shape == 3, F.concat(vendor, F.lit("__vitals__20260614.csv")))
            .when(shape == 4, F.concat(stem, F.lit(".xml")))
            .otherwise(F.concat(vendor, F.lit("-notes.csv"))),
        ).alias("object_key"),
    )


def q_key_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = paths.file_name("object_key")
    return object_keys(spark, sf_dir).select(
        "s_suppkey",
        name.alias("file_name"),
        paths.vendor_from_name("object_key").alias("vendor_from_name"),
        paths.vendor_from_path("object_key").alias("vendor_from_path"),
        paths.lineage_uuid("object_key").alias("lineage_uuid"),
        paths.object_vendor(name).alias("object_vendor"),
        paths.object_uuid(name).alias("object_uuid"),
        paths.silver_bucket(F.concat(F.lit("clinic-bronze-"), F.col("s_suppkey") % 3)).alias("bucket"),
        paths.silver_key("object_key").alias("silver_key"),
    )


def q_route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    extension = F.when(F.col("doc_id") % 4 == 0, ".XML").otherwise(".csv")
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), extension).alias("object_key"),
        F.col("n_chars").alias("object_size"),
    )
    return routing.route_files(files, bulk_bytes=ROUTE_BYTES)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notification messages from orders: two objects each, test events and broken ones."""

    def record(extension: str, size: Column) -> Column:
        key = F.concat(F.lit("v+"), F.col("o_orderstatus"), F.lit("/x%2B"), F.col("o_orderkey"), F.lit(extension))
        bucket = F.struct(F.lit("clinic-bronze").alias("name"))
        target = F.struct(key.alias("key"), size.cast("bigint").alias("size"))
        return F.struct(F.struct(bucket.alias("bucket"), target.alias("object")).alias("s3"))

    records = F.array(
        record(".csv", F.floor("o_totalprice")), record(".xml", F.floor("o_totalprice") + 1)
    )
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), key).alias("receipt"),
        F.when(key % 17 == 0, '{"Event":"s3:TestEvent"}')
        .when(key % 19 == 0, "{broken")
        .otherwise(F.to_json(F.struct(records.alias("Records"))))
        .alias("body"),
    )


def q_flatten_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.flatten_notifications(order_messages(spark, sf_dir))


def q_notification_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.notification_rejects(order_messages(spark, sf_dir))


def q_message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.col("o_custkey")).alias("receipt"),
        F.when(F.col("o_orderkey") % 11 == 0, "failed").otherwise("success").alias("status"),
    )
    return routing.message_outcomes(outcomes)


def q_file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = enrollment(spark, sf_dir).select(
        F.date_format("landed_on", "yyyyMMdd").alias("object_key"),
        cleaning.all_present(ENROLLMENT.non_blank).alias("is_valid"),
    )
    return quality.file_row_counts(landed)


def q_file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per day and vendor; days divisible by 13 have no vendor in their name."""
    named = F.dayofmonth("landed_on") % 13 != 0
    landed = enrollment(spark, sf_dir).select(
        F.concat(
            F.when(named, F.concat("source_vendor", F.lit("__vitals__"))).otherwise("scan-"),
            F.date_format("landed_on", "yyyyMMdd"),
            F.lit("__u1.csv"),
        ).alias("object_key"),
        (cleaning.all_present(ENROLLMENT.non_blank) & (F.col("row_number") % 3 == 0)).alias("is_valid"),
    )
    files = landed.select(
        "object_key",
        F.when(paths.object_vendor("object_key").isNull(), quality.NO_VENDOR).alias("reason"),
    ).distinct()
    return quality.file_outcomes(files, quality.file_row_counts(landed))


def q_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dedup_latest(staged_vitals(spark, sf_dir), ["encounter_id"])


def q_dedup_latest_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = staged_vitals(spark, sf_dir).withColumn("day", day_batch())
    return history.dedup_latest(daily, ["encounter_id", "day"])


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Active versions of the first hours, and everything behind them as a batch."""
    staged = staged_vitals(spark, sf_dir)
    cut = F.lit(FIRST_CUT).cast("timestamp_ntz")
    base = history.dedup_latest(staged.where(F.col("ingested_at") < cut), ["encounter_id"])
    return base.select(*history.version_columns(VITALS)), staged.where(F.col("ingested_at") >= cut)


def q_classify_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    active, batch = _two_batches(spark, sf_dir)
    rows = history.join_active(history.dedup_latest(batch, ["encounter_id"]), active)
    return rows.select(
        "encounter_id",
        F.col("ingested_at").alias("stream_ingested_at"),
        F.col("target.vitals_hash_key").alias("target_hash_key"),
        F.col("target.heart_rate").alias("target_heart_rate"),
        F.col("target.start_time").alias("target_start_time"),
        "action",
    )


def q_scd2_delta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    active, batch = _two_batches(spark, sf_dir)
    return history.scd2_delta_rows(batch, active)


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_rebuild(staged_vitals(spark, sf_dir), day_batch())


def q_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.current_state(daily_history(spark, sf_dir))


def q_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.state_as_of(daily_history(spark, sf_dir), AS_OF)


def q_chain_every_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.chain_every_arrival(staged_vitals(spark, sf_dir))


QUERIES = {
    "pseudonymize_hmac": q_pseudonymize_hmac,
    "pseudonymize_concat": q_pseudonymize_concat,
    "clear_identities": q_clear_identities,
    "surrogate_key": q_surrogate_key,
    "required_keys": q_required_keys,
    "required_keys_null_only": q_required_keys_null_only,
    "default_fill": q_default_fill,
    "trim_columns": q_trim_columns,
    "null_tokens": q_null_tokens,
    "drop_identity": q_drop_identity,
    "clean_rows": q_clean_rows,
    "typed_cast": q_typed_cast,
    "key_lineage": q_key_lineage,
    "route_files": q_route_files,
    "flatten_notifications": q_flatten_notifications,
    "notification_rejects": q_notification_rejects,
    "message_outcomes": q_message_outcomes,
    "file_row_counts": q_file_row_counts,
    "file_outcomes": q_file_outcomes,
    "dedup_latest": q_dedup_latest,
    "dedup_latest_daily": q_dedup_latest_daily,
    "classify_action": q_classify_action,
    "scd2_delta_rows": q_scd2_delta_rows,
    "scd2_rebuild": daily_history,
    "current_state": q_current_state,
    "state_as_of": q_state_as_of,
    "chain_every_arrival": q_chain_every_arrival,
}
