"""Physical layout of history rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.contracts import Contract


def history_layout(rows: DataFrame, contract: Contract, *leading: str) -> DataFrame:
    """Rows ranged and sorted by vendor and key, so that files cover narrow key ranges.

    The key takes part in the ranges: a vendor that holds a third of the rows spreads
    over many files.
    """
    order = [*leading, "source_vendor", *[k for k in contract.key if k != "source_vendor"]]
    return rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
