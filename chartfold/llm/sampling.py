"""A bounded sample of texts to fit a model on: bounded in rows, in bytes, and per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_BYTES = 64 << 20
TEXT_BYTES = 1 << 20  # longer texts are scored, but nothing is fitted on them


def texts_of(docs: DataFrame, ids: DataFrame, rows: int, seed: int) -> DataFrame:
    """(draw, text, others) of at most `rows` of the ids (doc_id, others), each once, in the order of
    a hash, as far as SAMPLE_BYTES reach. An id that several rows share gives the text of least hash.

    Only hashes and sizes move until the rows are chosen; the chosen ones are sorted in one task.
    """
    others = [c for c in ids.columns if c != "doc_id"]
    draw = F.xxhash64(F.lit(seed), "doc_id")
    few = ids.withColumn("draw", draw).orderBy("draw", "doc_id").limit(rows)
    name = F.xxhash64("text").alias("name")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    own = docs.select("doc_id", name, size).where(F.col("size") <= TEXT_BYTES).join(F.broadcast(few), "doc_id")
    one = own.groupBy("doc_id", "draw", *others).agg(F.min(F.struct("name", "size")).alias("least"))
    so_far = Window.orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = one.withColumn("bytes", F.sum("least.size").over(so_far)).where(F.col("bytes") <= SAMPLE_BYTES).select(
        "doc_id", "draw", *others, F.col("least.name").alias("name"))
    found = docs.select("doc_id", "text", name).join(F.broadcast(chosen), ["doc_id", "name"])
    return found.groupBy("doc_id", "draw", *others).agg(F.min("text").alias("text")).drop("doc_id")
