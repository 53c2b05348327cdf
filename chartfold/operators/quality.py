"""Per-file counts, and the verdict on each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chartfold.functions.paths import silver_key

HEADER_CONTRACT = "HEADER_CONTRACT"
NO_VALID_ROWS = "NO_VALID_ROWS"
NO_VENDOR = "NO_VENDOR"
MALFORMED = "MALFORMED"
ENCODING = "ENCODING"  # not UTF-8
EMPTY = "EMPTY"  # no bytes
MISSING = "MISSING"  # notified, not there


def file_row_counts(rows: DataFrame, file: str = "object_key") -> DataFrame:
    """Rows seen and rows kept per file; summed before the shuffle, so a giant file is no burden."""
    return rows.groupBy(file).agg(
        F.count("*").alias("rows_seen"), F.count_if("is_valid").alias("rows_written")
    )


def reject_empty_files(rows: DataFrame) -> DataFrame:
    """Valid rows. A file without any has none to give, so no join back is needed."""
    return rows.where("is_valid")


def survivor_count(rows: DataFrame, name: str = "survivors") -> tuple[DataFrame, Observation]:
    """Total rows seen and kept, gathered while some later action runs."""
    observation = Observation(name)
    observed = rows.observe(
        observation, F.count("*").alias("rows_seen"), F.count_if("is_valid").alias("rows_written")
    )
    return observed, observation


def verdict(
    files: DataFrame, counts: DataFrame, target: Column, file: str = "object_key",
    broken: Column | None = None,
) -> DataFrame:
    """One row per file: success with its counts and target, or failure with the reason.

    ``files`` has a column ``reason``, set where a file failed before its rows were read;
    ``broken`` is a reason that the counts give.
    """
    joined = files.join(counts, file, "left")
    joined = joined.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts.columns if c.startswith("rows_")}
    )
    reasons = [F.col("reason"), *([broken] if broken is not None else [])]
    error = F.coalesce(*reasons, F.when(F.col("rows_written") == 0, NO_VALID_ROWS))
    failed = error.isNotNull()
    return joined.withColumns(
        {
            "status": F.when(failed, "failed").otherwise("success"),
            "error": error,
            "rows_written": F.when(failed, 0).otherwise(F.col("rows_written")).cast("bigint"),
            "target": F.when(~failed, target),
        }
    )


def file_outcomes(files: DataFrame, counts: DataFrame, file: str = "object_key") -> DataFrame:
    """The verdicts on single files, whose targets are cleaned files of the same name."""
    judged = verdict(files, counts, silver_key(file), file)
    return judged.select(file, "status", "error", "rows_seen", "rows_written", "target")
