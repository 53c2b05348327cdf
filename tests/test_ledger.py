"""The ledger of ingested objects: lookups in recent and merged folders, and merges that were lost."""

from __future__ import annotations

import pytest

from chartfold.contracts import ENROLLMENT
from chartfold.plans import ingest, ledger
from chartfold.plans.ingest import OUTCOMES, Lake, ingest_batch
from chartfold.plans.ledger import Ledger
from chartfold.sources.landing import Landing


def outcomes(spark, names, status="success", redelivered=False):
    rows = [(n, "v" + n, status, None, 3, 2, 0, f"silver/{n}", redelivered) for n in names]
    return spark.createDataFrame(rows, OUTCOMES)


def states(spark, pairs):
    return spark.createDataFrame(pairs, "object_key string, object_version string")


def found(spark, book, names, batch_id=99):
    rows = book.lookup(spark, states(spark, [(n, "v" + n) for n in names] * 2), batch_id).collect()
    return sorted((r.object_key, r.rows_seen, r.rows_written, r.target) for r in rows)


def entries(names):
    return sorted((n, 3, 2, f"silver/{n}") for n in names)


def test_lookups_are_the_same_before_and_after_merges(spark, tmp_path):
    book = Ledger(str(tmp_path), buckets=4, merge_every=2)
    assert found(spark, book, ["a"]) == []
    every = []
    for number in (7, 3, 5, 4, 11, 12):  # batch ids in any order
        book.record(outcomes(spark, [f"{number}-{i}" for i in range(5)]), number)
        every += [f"{number}-{i}" for i in range(5)]
        before = found(spark, book, [*every, "other"])
        book.merge(spark)
        assert before == found(spark, book, [*every, "other"]) == entries(every)
    assert book._recent_ids(spark) == [] and book._merged(spark)[:2] == (2, 4)
    assert book.lookup(spark, states(spark, [("7-0", "another state"), ("7-0", None), (None, None)]), 99).count() == 0
    # A batch does not meet its own rows, or a repeated one would take its objects for known.
    assert found(spark, book, ["3-0", "4-0"], batch_id=3) == entries(["4-0"])


def test_failed_and_redelivered_objects_are_not_recorded(spark, tmp_path):
    book = Ledger(str(tmp_path), merge_every=1)
    book.record(outcomes(spark, ["bad"], status="failed"), 0)
    book.record(outcomes(spark, ["again"], redelivered=True), 1)
    book.merge(spark)
    assert found(spark, book, ["bad", "again"]) == []
    book.record(outcomes(spark, []), 2)
    book.merge(spark)
    assert found(spark, book, ["bad", "again"]) == []


def test_a_lookup_opens_the_buckets_of_its_objects(spark, tmp_path):
    book = Ledger(str(tmp_path), buckets=16, merge_every=1)
    names = [f"n{i}" for i in range(200)]
    book.record(outcomes(spark, names), 0)
    book.merge(spark)
    assert len(list(tmp_path.glob("merged/*/bucket=*"))) == 16
    opened = book.lookup(spark, states(spark, [("n5", "vn5")]), 1)
    folders = {path.split("/")[-2] for path in opened.inputFiles()}
    assert len([f for f in folders if f.startswith("bucket=")]) == 1
    # Another number of buckets takes effect with the next merge.
    wider = Ledger(str(tmp_path), buckets=3, merge_every=1)
    wider.record(outcomes(spark, [f"m{i}" for i in range(200)]), 1)
    wider.merge(spark)
    assert found(spark, wider, ["n5", "m7"]) == entries(["n5", "m7"])
    assert wider._merged(spark)[:2] == (1, 3)


def test_merges_wait_for_a_fair_share(spark, tmp_path):
    book = Ledger(str(tmp_path), buckets=2, merge_every=2, merge_share=0.5, most_recent=6)
    versions = []
    for number in range(9):
        book.record(outcomes(spark, [f"{number}-{i}" for i in range(1 if number > 1 else 10)]), number)
        book.merge(spark)
        last = book._merged(spark)
        versions.append(last[0] if last else None)
    # Twenty merged rows: two and four new ones are too few, six folders are too many.
    assert versions == [None, 0, 0, 0, 0, 0, 0, 1, 1]


class Lost(Exception):
    pass


@pytest.mark.parametrize("lost_at", ["complete", "delete"])
def test_a_lost_merge_changes_no_lookup(spark, tmp_path, monkeypatch, lost_at):
    book = Ledger(str(tmp_path), buckets=3, merge_every=1)
    book.record(outcomes(spark, ["a"]), 0)
    book.merge(spark)
    book.record(outcomes(spark, ["b"]), 1)

    def lost(*_):
        raise Lost

    with monkeypatch.context() as patch, pytest.raises(Lost):
        patch.setattr(ledger, lost_at, lost)
        book.merge(spark)
    assert found(spark, book, ["a", "b", "c"]) == entries(["a", "b"])
    book.merge(spark)
    book.record(outcomes(spark, ["c"]), 2)
    book.merge(spark)
    assert found(spark, book, ["a", "b", "c"]) == entries(["a", "b", "c"])
    assert book._recent_ids(spark) == []


@pytest.mark.parametrize("lost_in", ["write_once", "Ledger.merge"])
def test_a_batch_lost_around_its_ledger_ingests_each_object_once(spark, tmp_path, monkeypatch, lost_in):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "v__vitals__1__a.csv").write_text(
        "encounter_id,patient_id,enrollment_date,gpa\nE1,1,2026-06-01,3\n")
    landing, lake = Landing(str(tmp_path / "landing")), Lake(str(tmp_path / "lake"), merge_every=1)
    owner, _, name = lost_in.rpartition(".")

    def lost(*_):
        raise Lost

    with monkeypatch.context() as patch, pytest.raises(Lost):
        patch.setattr(getattr(ingest, owner) if owner else ingest, name, lost)
        ingest_batch(spark, landing, lake, 0, ENROLLMENT, "fixture-key")
    again = ingest_batch(spark, landing, lake, 0, ENROLLMENT, "fixture-key").collect()
    assert [(r.status, r.rows_written, r.redelivered) for r in again] == [("success", 1, False)]
    named = spark.createDataFrame([("v__vitals__1__a.csv",)], "object_key string")
    later = ingest_batch(spark, landing, lake, 1, ENROLLMENT, "fixture-key", named).collect()
    assert [(r.status, r.rows_written, r.redelivered) for r in later] == [("success", 1, True)]
    silver = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(lake.silver("csv"))
    assert silver.count() == 1
