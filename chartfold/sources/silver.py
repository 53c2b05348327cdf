"""Cleaned files of both lanes, read by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.contracts import Contract
from chartfold.functions.paths import scan_path
from chartfold.operators.cleaning import nullify_tokens, typed_columns
from chartfold.storage import literal_path


def select_files_by_pattern(df: DataFrame, pattern: str) -> DataFrame:
    """Rows of files whose whole path matches; Spark tests the file listing, not the rows."""
    return df.where(F.col("_metadata.file_path").rlike(f"^(?:{pattern})$"))


def silver_csv_rows(text: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows from silver text columns, with the NULL words taken out."""
    return typed_columns(nullify_tokens(text, text.columns), contract)


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of a folder by their header line. Files of one writer share theirs."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    first = lines.where("_metadata.file_block_start = 0").select(
        scan_path().alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    headers: dict[str, list[str]] = {}
    for row in first.groupBy("file").agg(F.min_by("value", "at").alias("header")).collect():
        headers.setdefault(row.header, []).append(row.file)
    return headers


def read_silver_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Typed rows of a silver CSV folder, by column name, in whatever order a file has them."""
    reader = spark.read.options(header="true", multiLine="true", escape='"', enforceSchema="false")
    tables = []
    for _, files in sorted(_by_header(spark, path).items()):
        text = reader.csv([literal_path(file) for file in files])
        tables.append(text.select(*[c for c in contract.silver_columns if c in text.columns]))
    if not tables:
        tables = [spark.createDataFrame([], contract.silver_text_schema)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return silver_csv_rows(merged, contract)


def read_silver_parquet(
    spark: SparkSession, path: str, contract: Contract, mixed: bool = False
) -> DataFrame:
    """Typed rows of a silver Parquet folder; a column it lacks is NULL.

    Where files differ in their columns, ``mixed`` looks into each of them first.
    """
    stored = spark.read.option("mergeSchema", str(mixed).lower()).parquet(path)
    names = [c for c in contract.silver_columns if c in stored.columns]
    return typed_columns(stored.select(*names), contract)
