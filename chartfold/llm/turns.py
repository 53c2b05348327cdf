"""Turns of conversations in order; shared by the operators on conversations.

Order within a conversation: turn (null first), role, SHA-256 of the text; null roles and texts
are empty. Turns that tie in all of these are equal, so that their order changes nothing. Null
conversation ids count as one conversation.

Skew: one conversation may hold a third of all turns. Rows are dealt out by ranges of that
order, numbered within each range, and shifted by what the ranges before hold of the same
conversation. A range continues at most one conversation, so the shifts are one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

RANGE_TURNS = 100_000
ORDER = ["conv_id", "turn", "role", "tie", "row"]


def cleaned(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without nulls in role and text, with what breaks ties."""
    text = F.coalesce("text", F.lit(""))
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("tie"), F.monotonically_increasing_id().alias("row"))


def in_ranges(rows: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """Cleaned rows dealt out by ranges of their order."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(max(least, -(-rows.count() // range_turns)), *ORDER)


def numbered(conversations: DataFrame, *carried: Column, range_turns: int = RANGE_TURNS) -> DataFrame:
    """(conv_id, pos, ...), positions from 1, with columns made of role and text."""
    rows = cleaned(conversations).select(*ORDER, *carried)
    columns = [c for c in rows.columns if c not in ORDER]
    ranges = in_ranges(rows, range_turns).withColumn("range", F.spark_partition_id())
    ranges = write_work_table(ranges.drop("row"), fresh_folder(rows.sparkSession, "turns"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.groupBy("conv_id", "range").count().withColumn("shift", F.sum("count").over(before))
    shifts = shifts.where("shift IS NOT NULL").select(
        F.col("conv_id").alias("of"), F.col("range").alias("at"), "shift")
    inside = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "tie")
    own = ranges.withColumn("inside", F.row_number().over(inside).cast("long"))
    same = (F.col("range") == F.col("at")) & F.col("conv_id").eqNullSafe(F.col("of"))
    return own.join(F.broadcast(shifts), same, "left").select(
        "conv_id", (F.col("inside") + F.coalesce("shift", F.lit(0))).alias("pos"), *columns)
