"""Landing files to history, over two batches."""

from __future__ import annotations

import contextlib
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from chartfold import storage
from chartfold.contracts import ENROLLMENT, VITALS
from chartfold.operators.history import scd2_rebuild
from chartfold.plans import landed
from chartfold.plans.ingest import Lake, ingest_batch
from chartfold.plans.oracles import ORACLES
from chartfold.plans.views import staged_vitals
from chartfold.sinks.silver import write_silver_csv, write_silver_parquet
from chartfold.sources.landing import Landing
from chartfold.streaming.fold import HistoryTable, fold_new_rows
from chartfold.streaming.staging import (
    append_staging,
    merge_lanes,
    read_staging,
    stream_silver_csv,
    stream_silver_parquet,
)
from oracle import compare, connect

HEADER = "encounter_id,patient_id,enrollment_date,gpa\n"
XML = (
    "<rs><record><encounter_id>E9</encounter_id><patient_id>9</patient_id>"
    "<enrollment_date>2026-06-01</enrollment_date><gpa>2</gpa></record></rs>"
)


def deliver(root, files):
    for name, text in files.items():
        root.mkdir(exist_ok=True)
        (root / name).write_text(text)
    return Landing(str(root))


def test_two_batches(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    history = HistoryTable(f"{lake.root}/history", ENROLLMENT)
    staging = f"{lake.root}/staging"
    batches = [
        {
            "v__vitals__1__a.csv": HEADER + "E1,1,2026-06-01,3\nE2,2,2026-06-01,3\n",
            "v__vitals__1__x.xml": XML,
        },
        {"w__vitals__2__b.csv": HEADER + "E1,1,2026-06-02,4\n"},
    ]
    for number, files in enumerate(batches):
        landing = deliver(tmp_path / f"landing{number}", files)
        for _ in range(2):
            ingest_batch(spark, landing, lake, number, ENROLLMENT, "fixture-key")
            lanes = merge_lanes(
                stream_silver_csv(spark, lake.silver("csv"), ENROLLMENT),
                stream_silver_parquet(spark, lake.silver("parquet"), ENROLLMENT),
            )
            append_staging(lanes, staging, f"{lake.root}/c1", ENROLLMENT).awaitTermination()
            fold_new_rows(spark, staging, history, f"{lake.root}/c2").awaitTermination()

    assert read_staging(spark, staging, ENROLLMENT).count() == 4
    assert history.committed_batches(spark) == [0, 1]
    rows = history.history(spark).collect()
    found = sorted((r.encounter_id, r.source_vendor, r.gpa, r.is_current) for r in rows)
    assert found == [
        ("E1", "v", "3", False),
        ("E1", "w", "4", True),
        ("E2", "v", "3", True),
        ("E9", "v", "2", True),
    ]
    closed = next(r for r in rows if not r.is_current)
    opened = next(r for r in rows if r.is_current and r.encounter_id == "E1")
    assert closed.end_time == opened.start_time
    assert len({r.vitals_hash_key for r in rows}) == 4


class Lost(Exception):
    pass


def lost_after_each_step(behind):
    def on_step(step):
        if step not in behind:
            behind.append(step)
            raise Lost

    return on_step


def staged_so_far(spark, lake):
    lanes = merge_lanes(
        stream_silver_csv(spark, lake.silver("csv"), ENROLLMENT),
        stream_silver_parquet(spark, lake.silver("parquet"), ENROLLMENT),
    )
    append_staging(lanes, f"{lake.root}/staging", f"{lake.root}/c1", ENROLLMENT).awaitTermination()
    return sorted(r.encounter_id for r in read_staging(spark, f"{lake.root}/staging", ENROLLMENT).collect())


def test_a_driver_lost_after_any_step_stages_each_row_once(spark, tmp_path):
    files = {"v__vitals__1__a.csv": HEADER + "E1,1,2026-06-01,3\nE2,2,2026-06-01,3\n", "v__vitals__1__x.xml": XML,
             "v__vitals__1__bad.csv": "visit\n1\n"}
    landing, lake = deliver(tmp_path / "landing", files), Lake(str(tmp_path / "lake"))
    for kind in ("csv", "parquet"):
        (tmp_path / "lake" / "silver" / kind).mkdir(parents=True)
    seen, steps = [], []
    while True:
        try:
            on_step = lost_after_each_step(steps)
            outcomes = ingest_batch(spark, landing, lake, 0, ENROLLMENT, "fixture-key", on_step=on_step)
            break
        except Lost:
            seen.append(staged_so_far(spark, lake))
    assert len(steps) == 20
    assert seen[0] == [] and ["E1", "E2"] in seen  # the lanes come one after the other
    assert seen[-1] == staged_so_far(spark, lake) == ["E1", "E2", "E9"]
    assert sorted(r.status for r in outcomes.collect()) == ["failed", "success", "success"]


@pytest.mark.parametrize("write", [write_silver_csv, write_silver_parquet])
def test_a_driver_lost_between_two_moves_leaves_each_file_once(spark, tmp_path, monkeypatch, write):
    lake, moved = Lake(str(tmp_path / "lake")), storage._moved
    for kind in ("csv", "parquet"):
        (tmp_path / "lake" / "silver" / kind).mkdir(parents=True)
    text = ", ".join(f"'x' as {c}" for c in ENROLLMENT.silver_columns if c not in ("encounter_id", "source_vendor"))
    rows = spark.range(0, 40, 1, 5).selectExpr(
        "concat('E', id) as encounter_id", "concat('v', id % 3) as source_vendor", *text.split(", "))
    folder = lake.silver("csv" if write is write_silver_csv else "parquet")

    def interrupted(allowed):
        def move(spark, source, target):
            if not allowed:
                raise Lost
            allowed.pop()
            moved(spark, source, target)
            if not allowed:  # a copying store: the file is at both places
                (tmp_path / source.replace("file:", "")).write_bytes((tmp_path / target.replace("file:", "")).read_bytes())

        return move

    for _ in range(3):
        with monkeypatch.context() as patch, pytest.raises(Lost):
            patch.setattr(storage, "_moved", interrupted([1]))
            patch.setattr(storage, "ThreadPoolExecutor", lambda _: contextlib.nullcontext(type("One", (), {"map": map})))
            write(rows, folder, 0, ENROLLMENT)
        staged_so_far(spark, lake)
    write(rows, folder, 0, ENROLLMENT)
    write(rows, folder, 0, ENROLLMENT)
    assert staged_so_far(spark, lake) == sorted(f"E{i}" for i in range(40))
    assert not list((tmp_path / "lake" / "silver").rglob("_staged/batch_id=0"))


def test_two_batches_over_one_object_write_it_once(spark, tmp_path):
    landing = deliver(tmp_path / "landing", {"v__vitals__1__a.csv": HEADER + "E1,1,2026-06-01,3\n"})
    lake = Lake(str(tmp_path / "lake"))
    for kind in ("csv", "parquet"):
        (tmp_path / "lake" / "silver" / kind).mkdir(parents=True)

    def at(last):
        def on_step(step):
            if step.endswith(last):
                raise Lost

        return on_step

    with pytest.raises(Lost):  # the rows are in silver, the ledger does not know it
        ingest_batch(spark, landing, lake, 0, ENROLLMENT, "fixture-key", on_step=at("csv/batch_id=0 complete"))
    with pytest.raises(RuntimeError, match="batch 0 is not finished"):
        ingest_batch(spark, landing, lake, 1, ENROLLMENT, "fixture-key")
    with pytest.raises(Lost):  # lost before it could give the lake back
        ingest_batch(spark, landing, lake, 0, ENROLLMENT, "fixture-key", on_step=at("outcomes/batch_id=0 complete"))
    named = spark.createDataFrame([("v__vitals__1__a.csv",)], "object_key string")
    again = ingest_batch(spark, landing, lake, 2, ENROLLMENT, "fixture-key", named).collect()
    assert [(r.status, r.redelivered) for r in again] == [("success", True)]
    assert staged_so_far(spark, lake) == ["E1"]
    assert not storage.exists(spark, lake.open_batch)


@pytest.mark.parametrize("bulk_bytes", [1, 2_000])
def test_redelivered_objects_has_the_rows_of_files_of_any_size(spark, tmp_path, monkeypatch, bulk_bytes):
    """All files large, and some: small ones go to one silver folder, large ones to the other."""
    duckdb.sql(f"""COPY (
        SELECT i AS o_orderkey, i % 50 AS o_custkey, substr('OFP', CAST(i % 3 AS INT) + 1, 1) AS o_orderstatus,
               TIMESTAMP '1997-01-05' + to_days(CAST(i % 40 * (i % 2) AS INT)) AS o_orderdate
        FROM range(1, 900) AS numbers(i)) TO '{tmp_path}/orders.parquet' (FORMAT parquet)""")
    land, lanes = landed.land_csv, []

    def land_large(spark, sf_dir):
        landing = replace(land(spark, sf_dir), bulk_bytes=bulk_bytes)
        lanes.extend(r.file_size >= bulk_bytes for r in landing.files(spark).collect())
        return landing

    monkeypatch.setattr(landed, "land_csv", land_large)
    found = landed.q_redelivered_objects(spark, str(tmp_path))
    assert set(lanes) == ({True} if bulk_bytes == 1 else {True, False})
    assert compare(found, ORACLES["redelivered_objects"], connect(str(tmp_path))) > 400


@pytest.mark.parametrize("max_files", [1, 3, 10_000])
def test_a_rebuild_from_staging_cuts_the_log_as_the_fold_did(spark, tmp_path, max_files):
    silver, staging = str(tmp_path / "silver"), str(tmp_path / "staging")
    history = HistoryTable(str(tmp_path / "history"), compact_every=2)
    rows = staged_vitals(spark, "/root/testdata/sf0.001").limit(600).withColumn(
        "encounter_id", F.when(F.col("heart_rate") % 50 != 0, F.concat(F.lit("E"), F.col("heart_rate") % 7)))
    for number in range(2):
        part = rows.where(F.pmod(F.xxhash64("ingested_at"), F.lit(2)) == number)
        part.repartition(2).write.parquet(f"{silver}/batch_id={number}")
        stream = stream_silver_parquet(spark, silver, VITALS, rows.schema)
        append_staging(stream, staging, str(tmp_path / "c1"), VITALS).awaitTermination()
        fold_new_rows(spark, staging, history, str(tmp_path / "c2"), max_files).awaitTermination()
    batches = history.committed_batches(spark)
    assert len(batches) > 2 if max_files == 1 else len(batches) >= 2
    staged = history.folded_staging(spark, staging)
    assert sorted(r.batch_id for r in staged.select("batch_id").distinct().collect()) == batches
    rebuilt = scd2_rebuild(staged, "batch_id")
    assert rebuilt.count() > 0 and history.late(spark).count() > 0
    assert sorted(map(repr, rebuilt.collect())) == sorted(map(repr, history.history(spark).collect()))
