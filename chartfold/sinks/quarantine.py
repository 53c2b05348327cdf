"""Copies of rejected files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.functions.paths import scan_path
from chartfold.sources.landing import Landing
from chartfold.storage import literal_path, qualified

# So many rejected files are opened by name at once; more take several writes.
NAMED_FILES = 10_000


def _copied(spark: SparkSession, paths: list[str], whole: bool) -> DataFrame:
    """Raw text of files: whole, or, for large ones, line by line. Bytes stay as they are.

    The writer ends each value with a line feed, so one at the end of a whole file is cut.
    """
    raw = F.col("value").cast("binary")
    cut = F.when(F.endswith("value", F.lit("\n")), F.substring(raw, F.lit(1), F.octet_length("value") - 1))
    value = F.coalesce(cut, raw).cast("string") if whole else F.col("value")
    text = spark.read.text([literal_path(p) for p in paths], wholetext=whole, lineSep=None if whole else "\n")
    return text.select(value.alias("value"), scan_path().alias("file_path"))


def quarantine_files(
    spark: SparkSession, landing: Landing, rejected: DataFrame, folder: str
) -> int:
    """Copy rejected files, ``(file_path, file_size, object_key)``, to one folder each; returns
    how many. Only a file without a final line feed differs from its copy, which has one.

    The quarantine must lie outside the landing folder, or it would be ingested again.
    """
    if f"{qualified(spark, folder)}/".startswith(f"{qualified(spark, landing.root)}/"):
        raise ValueError("the quarantine folder lies inside the landing folder")
    found = rejected.select("file_path", "file_size", "object_key").where("file_size > 0").distinct()
    rows = found.collect()
    mode = "overwrite"
    for whole in (True, False):
        paths = [r.file_path for r in rows if (r.file_size < landing.bulk_bytes) == whole]
        for at in range(0, len(paths), NAMED_FILES):
            copied = _copied(spark, paths[at:at + NAMED_FILES], whole).join(found, "file_path")
            copied.select("value", F.col("object_key").alias("file_name")).write.mode(mode).partitionBy(
                "file_name").option("lineSep", "\n").text(folder)
            mode = "append"
    return len(rows)
