from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartfold.contracts import VITALS
from chartfold.operators.history import chain_every_arrival, dedup_latest, scd2_delta_rows, scd2_rebuild
from chartfold.plans.views import day_batch, staged_vitals
from chartfold.streaming.fold import HistoryTable

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2026, 6, 14)


def at(minute, second=0):
    return DAY.replace(hour=10, minute=minute, second=second)


def reading(encounter, vendor, rate, when, uuid="f"):
    return (encounter, f"h-{encounter}", rate, "120/80", 36.5, vendor, uuid, when)


BATCHES = [
    [
        reading("E101", "vendor_A", 70, at(0)),
        reading("E101", "vendor_A", 72, at(0, 1)),
        reading("E102", "vendor_A", 80, at(0)),
    ],
    [reading("E101", "vendor_B", 75, at(5))],
    [reading("E101", "vendor_B", 75, at(10))],
]
EXPECTED = [
    ("E101", "vendor_A", 72, at(0, 1), at(5), False),
    ("E101", "vendor_B", 75, at(5), at(10), False),
    ("E101", "vendor_B", 75, at(10), None, True),
    ("E102", "vendor_A", 80, at(0), None, True),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, VITALS.staging_schema())


def shown(history):
    rows = history.select(
        "encounter_id", "source_vendor", "heart_rate", "start_time", "end_time", "is_current"
    ).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def everything(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("compact_every", [1, 2, 12])
def test_fold_fixture(spark, tmp_path, compact_every):
    table = HistoryTable(str(tmp_path), compact_every=compact_every)
    for number, rows in enumerate(BATCHES):
        table.fold(spark, frame(spark, rows), number, "s")
    assert shown(table.history(spark)) == sorted(EXPECTED, key=repr)
    assert table.current(spark).count() == 2
    for number, rows in enumerate(BATCHES):
        table.fold(spark, frame(spark, rows), number, "s")
    table.vacuum(spark, keep=1)
    assert shown(table.history(spark)) == sorted(EXPECTED, key=repr)


def test_rows_sent_again_in_a_later_batch_change_nothing(spark, tmp_path):
    table = HistoryTable(str(tmp_path))
    for number, rows in enumerate([BATCHES[0], BATCHES[0], BATCHES[1], BATCHES[1]]):
        table.fold(spark, frame(spark, rows), number, "s")
    assert shown(table.history(spark)) == [
        ("E101", "vendor_A", 72, at(0, 1), at(5), False),
        ("E101", "vendor_B", 75, at(5), None, True),
        ("E102", "vendor_A", 80, at(0), None, True),
    ]
    assert table.late(spark).count() == 0


def test_late_rows_are_set_aside(spark, tmp_path):
    table = HistoryTable(str(tmp_path), compact_every=2)
    for number, rows in enumerate([BATCHES[1], BATCHES[0], BATCHES[2]]):
        table.fold(spark, frame(spark, rows), number, "s")
    assert [(r.encounter_id, r.heart_rate) for r in table.late(spark).collect()] == [("E101", 72)]
    log = [
        frame(spark, rows).withColumn("batch", F.lit(number))
        for number, rows in enumerate([BATCHES[1], BATCHES[0], BATCHES[2]])
    ]
    rebuilt = scd2_rebuild(log[0].union(log[1]).union(log[2]), "batch")
    assert everything(table.history(spark)) == everything(rebuilt)


def test_skip_unchanged(spark, tmp_path):
    table = HistoryTable(str(tmp_path), skip_unchanged=True)
    for number, rows in enumerate(BATCHES):
        table.fold(spark, frame(spark, rows), number, "s")
    assert shown(table.history(spark)) == [
        ("E101", "vendor_A", 72, at(0, 1), at(5), False),
        ("E101", "vendor_B", 75, at(5), None, True),
        ("E102", "vendor_A", 80, at(0), None, True),
    ]


def test_compaction_waits_for_a_fair_share(spark, tmp_path):
    table = HistoryTable(str(tmp_path), compact_every=1, compact_share=1.0, most_deltas=3)
    versions = []
    for number in range(6):
        one = [reading(f"E{number}", "v", 70, at(number))] if number else BATCHES[0]
        table.fold(spark, frame(spark, one), number, "s")
        versions.append(table._commit(spark, number).base_version)
    # Two rows in the base: one new row is too few, two are as many, three deltas too many.
    assert versions == [0, 0, 2, 2, 2, 5]
    assert table.current(spark).count() == 7


def test_a_tie_with_other_values_is_set_aside(spark, tmp_path):
    table = HistoryTable(str(tmp_path))
    other = [reading("E102", "vendor_A", 99, at(0))]
    for number, rows in enumerate([BATCHES[0], other, BATCHES[0]]):
        table.fold(spark, frame(spark, rows), number, "s")
    assert [(r.encounter_id, r.heart_rate) for r in table.late(spark).collect()] == [("E102", 99)]
    assert table.history(spark).count() == 2


def test_unfinished_batch_is_written_again(spark, tmp_path):
    table = HistoryTable(str(tmp_path))
    table.fold(spark, frame(spark, BATCHES[0]), 0, "s")
    # What a driver lost before the commit leaves behind:
    frame(spark, BATCHES[2]).write.parquet(f"{tmp_path}/delta/batch_id=1/kind=open")
    (tmp_path / "commits" / "batch_id=1").mkdir()
    assert table.current(spark).count() == 2
    table.fold(spark, frame(spark, BATCHES[1]), 1, "s")
    table.fold(spark, frame(spark, BATCHES[2]), 2, "s")
    assert shown(table.history(spark)) == sorted(EXPECTED, key=repr)


def test_foreign_or_skipped_batches_fail(spark, tmp_path):
    table = HistoryTable(str(tmp_path))
    table.fold(spark, frame(spark, BATCHES[0]), 0, "s")
    with pytest.raises(RuntimeError):
        table.fold(spark, frame(spark, BATCHES[1]), 1, "other")
    with pytest.raises(RuntimeError):
        table.fold(spark, frame(spark, BATCHES[1]), 0, "other")
    with pytest.raises(RuntimeError):
        table.fold(spark, frame(spark, BATCHES[1]), 5, "s")


def test_ties_have_a_fixed_winner(spark):
    rows = [reading("E1", "v", rate, at(0), uuid) for rate, uuid in ((1, "a"), (2, "b"), (3, "b"))]
    for order in (rows, rows[::-1]):
        kept = dedup_latest(frame(spark, order).repartition(3), ["encounter_id"]).collect()
        assert [(r.heart_rate, r.lineage_file_uuid) for r in kept] == [(3, "b")]


def test_rows_without_key_are_kept_aside(spark, tmp_path):
    table = HistoryTable(str(tmp_path))
    rows = [*BATCHES[0], (None, "h", 1, "", 1.0, "v", "f", at(0))]
    table.fold(spark, frame(spark, rows), 0, "s")
    assert table.history(spark).count() == 2
    assert spark.read.parquet(f"{tmp_path}/unusable/batch_id=0").count() == 1


def test_literal_rule_never_expires(spark):
    """Each batch copies all active rows of a key, so they double from batch to batch."""
    held = spark.createDataFrame([], VITALS.history_schema())
    for rows in BATCHES:
        added = scd2_delta_rows(frame(spark, rows), held)
        held = spark.createDataFrame(held.collect() + added.collect(), VITALS.history_schema())
    one = held.where("encounter_id = 'E101'")
    assert one.where("is_current").count() == 4
    assert one.where("not is_current").count() == 3


def test_fold_equals_rebuild_on_days(spark, tmp_path):
    staged = staged_vitals(spark, SF).withColumn("day", day_batch())
    table = HistoryTable(str(tmp_path), compact_every=3)
    days = [r.day for r in staged.select("day").distinct().orderBy("day").limit(7).collect()]
    for number, day in enumerate(days):
        table.fold(spark, staged.where(F.col("day") == F.lit(day)), number, "s")
    rebuilt = scd2_rebuild(staged.where(F.col("day").isin(days)).drop("day"), day_batch())
    history = table.history(spark)
    assert everything(history) == everything(rebuilt)
    assert history.where("is_current").count() == history.select("encounter_id").distinct().count()


def test_intervals_are_gap_free(spark):
    rebuilt = scd2_rebuild(staged_vitals(spark, SF), day_batch())
    starts = rebuilt.select("encounter_id", F.col("start_time").alias("end_time"))
    closed = rebuilt.where("not is_current")
    assert closed.join(starts, ["encounter_id", "end_time"], "left_anti").count() == 0
    assert rebuilt.where("end_time <= start_time").count() == 0


def test_vendor_as_part_of_the_key(spark, tmp_path):
    """Two vendors may use one encounter id without closing each other's versions."""
    contract = VITALS.keyed_by("encounter_id", "source_vendor")
    table = HistoryTable(str(tmp_path), contract, compact_every=2)
    for number, rows in enumerate(BATCHES):
        table.fold(spark, frame(spark, rows), number, "s")
    assert shown(table.current(spark)) == [
        ("E101", "vendor_A", 72, at(0, 1), None, True),
        ("E101", "vendor_B", 75, at(10), None, True),
        ("E102", "vendor_A", 80, at(0), None, True),
    ]


def many(numbers, minute):
    return [reading(f"E{n:04d}", "vendor_A", 60 + minute, at(minute)) for n in numbers]


def folders(df):
    return {tuple(part for part in file.split("/") if part.startswith(("version=", "bucket="))) for file in df.inputFiles()}


def test_a_batch_opens_the_buckets_of_its_keys(spark, tmp_path):
    table = HistoryTable(str(tmp_path), compact_every=1, buckets=8)
    table.fold(spark, frame(spark, many(range(200), 0)), 0, "s")
    assert len(folders(table._base(spark, 0))) == 8
    one = frame(spark, many([7], 1))
    touched = table._touched(spark, one, 0, 0)
    assert len(folders(touched)) == 1
    assert [r.encounter_id for r in touched.collect()] == ["E0007"]


def test_a_new_base_writes_touched_buckets_only(spark, tmp_path):
    table = HistoryTable(str(tmp_path), compact_every=1, compact_share=0.0, buckets=8)
    table.fold(spark, frame(spark, many(range(200), 0)), 0, "s")
    for batch_id in (1, 2, 3):
        table.fold(spark, frame(spark, many([7, 1000 + batch_id], batch_id)), batch_id, "s")
        version, _ = table._state(spark)
        assert version == batch_id
        rewritten = [f for f in folders(table._base(spark, version)) if f[0] == f"version={batch_id}"]
        assert 1 <= len(rewritten) <= 2
    before = everything(table.history(spark))
    assert table.current(spark).count() == 203 and len(before) == 206
    table.vacuum(spark, keep=1)
    assert everything(table.history(spark)) == before
    table.fold(spark, frame(spark, many([7], 9)), 4, "s")
    table.vacuum(spark, keep=3)
    assert table.current(spark).where("heart_rate = 69").count() == 1


def test_another_number_of_buckets_takes_effect_with_the_next_base(spark, tmp_path):
    first = HistoryTable(str(tmp_path), compact_every=1, buckets=4)
    first.fold(spark, frame(spark, many(range(50), 0)), 0, "s")
    other = HistoryTable(str(tmp_path), compact_every=2, compact_share=0.0, buckets=7)
    other.fold(spark, frame(spark, many([3, 90], 1)), 1, "s")
    assert other.current(spark).count() == 51 and other._places(spark, other._state(spark)[0])[0] == 4
    other.fold(spark, frame(spark, many([3], 2)), 2, "s")
    version, _ = other._state(spark)
    assert version == 2 and other._places(spark, version)[0] == 7
    assert other.current(spark).count() == 51
    assert {f[0] for f in folders(other._base(spark, version))} == {"version=2"}


def test_a_base_without_rows(spark, tmp_path):
    table = HistoryTable(str(tmp_path), compact_every=1, most_deltas=1)
    table.fold(spark, frame(spark, []), 0, "s")
    table.fold(spark, frame(spark, BATCHES[0]), 1, "s")
    assert table.current(spark).count() == 2


def test_chain_of_a_hot_key_spreads_over_tasks(spark):
    """One key with 40,000 arrivals within 20 minutes, others that lie years apart, and ties."""
    micros = F.when(F.col("id") < 40_000, F.col("id") * 30_011).otherwise(F.col("id") * 123_456_789_012 - (1 << 52))
    arrivals = spark.range(50_000).select(
        F.when(F.col("id") < 40_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("encounter_id"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("ingested_at"))
    rows = arrivals.select(*[
        F.col(f.name) if f.name in arrivals.columns else F.lit("1").cast(f.dataType).alias(f.name)
        for f in VITALS.staging_schema()])
    made = chain_every_arrival(rows.unionByName(rows.where("ingested_at > '1970-01-01'").limit(500)))
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = made.withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    found = found.sort_values(["encounter_id", "start_time"])
    expected = found.groupby("encounter_id")["start_time"].shift(-1)
    assert len(found) == 50_000 and found["end_time"].equals(expected.rename("end_time"))
    assert (found["is_current"] == expected.isna()).all() and found["is_current"].sum() == 701
    hot = found[found["encounter_id"] == "hot"].groupby("task").size()
    assert len(hot) == int(spark.conf.get("spark.sql.shuffle.partitions")) and hot.max() < 2 * hot.min()


def test_chain_takes_rows_without_key_as_one_key(spark):
    rows = [reading(None, "v", 1, at(m)) for m in (0, 59)] + [reading("E", "v", 1, at(5))]
    ends = {(r.encounter_id, r.start_time): r.end_time for r in chain_every_arrival(
        spark.createDataFrame(rows, "encounter_id string, hashed_patient_id string, heart_rate int, blood_pressure string, "
                              "temperature double, source_vendor string, lineage_file_uuid string, ingested_at timestamp_ntz")).collect()}
    assert ends == {(None, at(0)): at(59), (None, at(59)): None, ("E", at(5)): None}
