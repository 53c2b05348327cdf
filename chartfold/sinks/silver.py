"""Silver folders, one per lane and ingest batch, written once: a stream may read them at any time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.contracts import Contract
from chartfold.storage import write_once


def write_silver_csv(
    rows: DataFrame, folder: str, batch_id: int, contract: Contract, on_step: Callable[[str], None] = lambda step: None
) -> str:
    """Contract columns in order, with a header."""

    def write(path: str) -> None:
        writer = rows.select(*contract.silver_columns).write.mode("overwrite")
        writer.options(header="true", escape='"').csv(path)

    return write_once(rows.sparkSession, f"{folder}/batch_id={batch_id}", write, on_step)


def write_silver_parquet(
    rows: DataFrame, folder: str, batch_id: int, contract: Contract, on_step: Callable[[str], None] = lambda step: None
) -> str:
    """Contract columns in one directory per vendor; the vendor also stays a column.

    The rebalance step gathers the rows of a vendor, and splits a vendor too large for
    one task.
    """

    def write(path: str) -> None:
        parted = rows.select(*contract.silver_columns, F.col("source_vendor").alias("vendor_part"))
        writer = parted.hint("rebalance", "vendor_part").write.mode("overwrite")
        writer.partitionBy("vendor_part").parquet(path)

    return write_once(rows.sparkSession, f"{folder}/batch_id={batch_id}", write, on_step)
