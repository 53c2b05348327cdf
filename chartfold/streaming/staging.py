"""Both silver lanes into one staging table, and staging as a stream of appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chartfold.contracts import Contract
from chartfold.operators.cleaning import typed_columns
from chartfold.sources.silver import silver_csv_rows

STAGED_IN = "staged_in"


def stream_silver_csv(
    spark: SparkSession, folder: str, contract: Contract, max_files: int = 10_000
) -> DataFrame:
    """Silver CSV files as a stream. A file whose header is not the contract's stops it: values
    are placed by position here, and must not land under another name.
    """
    text = (
        spark.readStream.options(header="true", multiLine="true", escape='"', enforceSchema="false")
        .option("maxFilesPerTrigger", max_files)
        .schema(contract.silver_text_schema)
        .csv(folder)
        .select(*contract.silver_columns)
    )
    return silver_csv_rows(text, contract)


def stream_silver_parquet(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    stored: T.StructType | None = None,
    max_files: int = 10_000,
) -> DataFrame:
    """``stored`` is the schema of the files; by default all text, as an ingest batch writes."""
    schema = stored or contract.silver_text_schema
    wanted = [*contract.silver_columns, "ingested_at"]
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)
    )
    return typed_columns(rows.select(*[c for c in wanted if c in schema.names]), contract)


def merge_lanes(*lanes: DataFrame) -> DataFrame:
    """All rows of all lanes; a column that a lane lacks is NULL."""
    merged = lanes[0]
    for other in lanes[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def staged_in() -> Column:
    """The staging file of a row: files are never changed, and one batch of a stream takes all of one."""
    return F.col("_metadata.file_path").alias(STAGED_IN)


def load_time() -> Column:
    """Start of the micro-batch, in UTC. Spark logs it, so a repeated batch has the same."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def append_staging(
    rows: DataFrame, staging: str, checkpoint: str, contract: Contract
) -> StreamingQuery:
    """Append what is new to the staging table, then stop.

    The file sink keeps a log of committed files, which readers honour: a repeated batch
    adds nothing. Rows with a value that does not fit its type go to ``rejected=true``.
    """
    if "ingested_at" not in rows.columns:
        rows = rows.withColumn("ingested_at", load_time())
    staged = rows.select(
        *contract.silver_columns,
        "ingested_at",
        "cast_errors",
        (F.size("cast_errors") > 0).alias("rejected"),
    )
    return (
        staged.writeStream.format("parquet")
        .partitionBy("rejected")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(staging)
    )


def _stored_schema(contract: Contract) -> T.StructType:
    return (
        T.StructType(contract.staging_schema().fields)
        .add("cast_errors", T.ArrayType(T.StringType()))
        .add("rejected", T.BooleanType())
    )


def read_staging(spark: SparkSession, staging: str, contract: Contract, *more: Column) -> DataFrame:
    rows = spark.read.schema(_stored_schema(contract)).parquet(staging).where("not rejected")
    return rows.select(*contract.silver_columns, "ingested_at", *more)


def read_staging_rejects(spark: SparkSession, staging: str, contract: Contract) -> DataFrame:
    return spark.read.schema(_stored_schema(contract)).parquet(staging).where("rejected")


def staging_changes(
    spark: SparkSession, staging: str, contract: Contract, max_files: int = 10_000
) -> DataFrame:
    """Appends to staging since the last one a query consumed, each row with its file; the
    checkpoint of the query remembers."""
    rows = (
        spark.readStream.schema(_stored_schema(contract))
        .option("maxFilesPerTrigger", max_files)
        .parquet(staging)
        .where("not rejected")
    )
    return rows.select(*contract.silver_columns, "ingested_at", staged_in())
