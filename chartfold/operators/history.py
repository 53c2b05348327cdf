"""Latest rows, and type-2 history of a staging table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.contracts import VITALS, Contract
from chartfold.functions.privacy import surrogate_key


def _tiebreak(df: DataFrame, used: list[str]) -> list[Column]:
    """All other columns, lineage first: two different rows never tie."""
    first = [c for c in ("lineage_file_uuid",) if c in df.columns]
    rest = [c for c in df.columns if c not in first]
    return [F.col(c).desc_nulls_last() for c in [*first, *rest] if c not in used]


def dedup_latest(df: DataFrame, keys: list[str], order: str = "ingested_at") -> DataFrame:
    """The latest row per key, with a fixed winner among equal times.

    Spark limits each group to its first row before the shuffle, so a key that holds a
    third of the table sends one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(
        F.col(order).desc_nulls_first(), *_tiebreak(df, [*keys, order])
    )
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def version_columns(contract: Contract, end: Column | None = None) -> list[Column]:
    """History columns of the version that a staging row opens, active unless it has an end."""
    ended = F.lit(None).cast("timestamp_ntz") if end is None else end
    return [
        surrogate_key(contract.key[0], "source_vendor", "ingested_at").alias("vitals_hash_key"),
        *[F.col(c) for c in contract.silver_columns],
        F.col("ingested_at").alias("start_time"),
        ended.alias("end_time"),
        ended.isNull().alias("is_current"),
    ]


def join_active(latest: DataFrame, active: DataFrame, contract: Contract = VITALS) -> DataFrame:
    """Each latest row beside the active version of its key, if there is one.

    The active version is the struct ``target``, and ``action`` says whether the row
    starts a key (INSERT) or follows a version (UPDATE), whatever its values are.
    """
    names = [f.name for f in contract.history_schema().fields]
    target = active.where("is_current").select(
        *[F.col(k).alias(f"_key_{k}") for k in contract.key], F.struct(*names).alias("target")
    )
    same_key = [F.col(k) == F.col(f"_key_{k}") for k in contract.key]
    joined = latest.join(target, same_key, "left").drop(*[f"_key_{k}" for k in contract.key])
    return joined.withColumn("action", classify_action("target"))


def classify_action(target: str) -> Column:
    return F.when(F.col(target).isNull(), "INSERT").otherwise("UPDATE")


def closed_version(ended: Column | str = "ingested_at") -> Column:
    """The struct ``target`` with its end set; everything else stays as it was."""
    end = F.col(ended) if isinstance(ended, str) else ended
    return F.col("target").withField("end_time", end).withField("is_current", F.lit(False))


def opened_version(contract: Contract = VITALS) -> Column:
    return F.struct(*version_columns(contract))


def scd2_delta_rows(batch: DataFrame, active: DataFrame, contract: Contract = VITALS) -> DataFrame:
    """What one batch inserts under the insert-only rule: closed copies and open rows.

    Conformance mode. The closed copy takes patient and vendor from the incoming row, and
    nothing expires the version it copies. For a history that holds, see ``scd2_rebuild``
    and :mod:`chartfold.streaming.fold`.
    """
    rows = join_active(dedup_latest(batch, list(contract.key)), active, contract)
    copied = closed_version()
    for name in (*contract.key, "hashed_patient_id", "source_vendor"):
        copied = copied.withField(name, F.col(name))
    copied = F.when(F.col("action") == "UPDATE", copied)
    branches = F.array_compact(F.array(copied, opened_version(contract)))
    return rows.select(F.explode(branches).alias("version")).select("version.*")


def scd2_rebuild(
    staging: DataFrame, batch: Column | str, contract: Contract = VITALS
) -> DataFrame:
    """The whole history from the staging log, as folding it batch by batch would give.

    ``batch`` orders the batches. Each batch offers the latest row of a key. A row that is
    not newer than everything its key had before is a replay or late and opens nothing.
    A key has one row per batch in the second shuffle, however many arrivals it had.
    """
    cut = F.col(batch) if isinstance(batch, str) else batch
    rows = staging.withColumn("_batch", cut)
    offered = dedup_latest(rows, [*contract.key, "_batch"])
    by_batch = Window.partitionBy(*contract.key).orderBy("_batch")
    before = by_batch.rowsBetween(Window.unboundedPreceding, -1)
    seen = offered.withColumn("_seen", F.max("ingested_at").over(before))
    accepted = seen.where("_seen is null or ingested_at > _seen")
    ended = accepted.withColumn("_ended", F.lead("ingested_at").over(by_batch))
    return ended.select(*version_columns(contract, F.col("_ended")))


# A slot of times, in bits of microseconds: about 66 ms, 72 minutes and 9 years.
SLOT_BITS = (16, 32, 48)


def _with_next(rows: DataFrame, keys: list[str], slot_bits: tuple[int, ...] = SLOT_BITS) -> DataFrame:
    """Rows of distinct (keys, ingested_at) with the next such time of their keys, ``_next``.

    A window spans one slot of a key. For the last row of a slot the next time is the
    beginning of the key's next slot, which is found the same way in coarser slots.
    """
    if not slot_bits:
        later = Window.partitionBy(*keys).orderBy("ingested_at")
        return rows.withColumn("_next", F.lead("ingested_at").over(later))
    slot, bits = f"_slot{slot_bits[0]}", slot_bits[0]
    slotted = rows.withColumn(slot, F.shiftright(F.unix_micros(F.col("ingested_at").cast("timestamp")), bits))
    inside = Window.partitionBy(*keys, slot).orderBy("ingested_at")
    linked = slotted.withColumn("_inside", F.lead("ingested_at").over(inside))
    starts = slotted.groupBy(*keys, slot).agg(F.min("ingested_at").alias("ingested_at"))
    following = _with_next(starts, keys, slot_bits[1:]).select(
        *[F.col(c).alias(f"_of_{c}") for c in [*keys, slot]], F.col("_next").alias("_outside")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*keys, slot]]
    chained = linked.join(following, reduce(Column.__and__, same), "left")
    return chained.select(*rows.columns, F.coalesce("_inside", "_outside").alias("_next"))


# A key with more arrivals is chained slot by slot; all others in one window each.
HOT_ARRIVALS = 4_096


def chain_distinct(distinct: DataFrame, contract: Contract = VITALS, hot_arrivals: int = HOT_ARRIVALS) -> DataFrame:
    """The same of rows of which no two share key and time."""
    keys = list(contract.key)
    counts = distinct.groupBy(*keys).agg(F.count("*").alias("_arrivals"))
    # Few: at most one in so many rows of the table.
    hot = F.broadcast(counts.where(F.col("_arrivals") > hot_arrivals).select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    chained = [_with_next(distinct.join(hot, same, "left_anti"), keys, ()),
               _with_next(distinct.join(hot, same, "left_semi"), keys)]
    return chained[0].unionByName(chained[1]).select(*version_columns(contract, F.col("_next")))


def chain_every_arrival(staging: DataFrame, contract: Contract = VITALS) -> DataFrame:
    """History in which every arrival opens a version, so that batch cuts do not matter.

    Nothing bounds the arrivals of a key, but those of one slot of time are bounded: no window
    and no group of the joins has more than 65,536 rows, however hot a key or an hour is.
    """
    return chain_distinct(dedup_latest(staging, [*contract.key, "ingested_at"]), contract)


def current_state(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def state_as_of(history: DataFrame, moment: Column | str) -> DataFrame:
    """The version of each key that was valid at a moment."""
    at = F.lit(moment).cast("timestamp_ntz") if isinstance(moment, str) else moment
    return history.where(
        (F.col("start_time") <= at) & (F.col("end_time").isNull() | (at < F.col("end_time")))
    )
