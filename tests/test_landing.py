from __future__ import annotations

import csv
import hashlib
import hmac
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chartfold.contracts import ENROLLMENT
from chartfold.plans import ingest
from chartfold.plans.ingest import Lake, ingest_batch
from chartfold.sources.landing import Landing, list_files, read_landing
from chartfold.sources.silver import select_files_by_pattern

KEY = "fixture-key"
HEADER = "encounter_id,patient_id,enrollment_date,gpa\n"
RECORD = (
    "<record><encounter_id>{}</encounter_id><patient_id>3</patient_id>"
    "<enrollment_date>2026-03-01</enrollment_date><gpa>1</gpa></record>"
)
FILES = {
    "north/north__vitals__20260302__f7.csv": HEADER
    + "N-1,kim-04,2026-02-27,1.25\nN-2,lee-11,2026-02-28,\n",
    "south/south__vitals__20260302__bad.csv": "visit,patient_id,enrollment_date,gpa\n"
    "N-1,kim-04,2026-02-27,1.25\n",
    "south/south__vitals__20260302__gone.csv": HEADER
    + ",kim-04,2026-02-27,1.25\nN-3,,2026-03-01,2.75\n",
    "south/south__vitals__20260302__latin.csv": (HEADER + "N-4,JOS\u00c9,2026-03-01,2\n").encode("latin-1"),
    "vendor_C/vendor_C__vitals__20260302__mixed.csv": "gpa,patient_id,encounter_id,enrollment_date,extra\n"
    '1.5, pid999 ,E1,2026-06-01,"a, ""b""\nc"\n'
    ',00123,E2,2026-06-02,x\n3,"  ",E3,2026-06-03,x\n'
    '2,7,"E4\nnext",2026-06-04,x\n,8,E5\n',
    "vendor_C/vendor_C__vitals__20260302__bom.csv": "﻿" + HEADER + "E6,9,2026-06-01,1\n",
    "X/X__vitals__2026__u1.CSV": HEADER.replace("gpa", '"gpa"') + "E7,9,2026-06-01,1\n",
    "a b/a__b__vitals__2026__u+1.csv": HEADER + "E8,9,2026-06-01,1\n",
    "novitals.csv": HEADER + "E9,9,2026-06-01,1\n",
    "D/D__vitals__2026__open.csv": HEADER + 'E0,9,2026-06-01,1\nE0,9,"2026-06-01,1\nE0,9,2026-06-01,1\n',
    "D/D__vitals__2026__empty.csv": "",
    "D/D__vitals__2026__headonly.csv": HEADER,
    "D/D__vitals__2026__x1.xml": "<rs><record><encounter_id>E10</encounter_id>"
    "<patient_id>00123</patient_id>\n<enrollment_date>2026-06-01</enrollment_date>"
    "<gpa>2</gpa></record>\n<record><encounter_id>E11</encounter_id><patient_id>5</patient_id>"
    "<gpa/></record></rs>",
    "D/D__vitals__2026__x2.XML": "<rs><record><encounter_id>E12</encounter_id>"
    "<patient_id>1</patient_id></record></rs>",
    "D/D__vitals__2026__x3.xml": "<rs><record><encounter_id>E13</encounter_id><patient_id>1</rec",
    "D/D__vitals__2026__x4.xml": "<rs>" + RECORD.format("E14") + "<record><encounter_id>E15</x></record>" + RECORD.format("E16")
    + "</rs>",
    "D/D__vitals__2026__x5.xml": "<rs>" + RECORD.format("E17<!-- </record> -->") + RECORD.format("<![CDATA[E18</record>]]>")
    + "</rs>",
}


def pseudonym(identity: str) -> str:
    return hmac.new(KEY.encode(), identity.strip().upper().encode(), hashlib.sha256).hexdigest()


EXPECTED = {
    ("N-1", pseudonym("kim-04"), "2026-02-27", "1.25", "north", "f7"),
    ("N-2", pseudonym("lee-11"), "2026-02-28", "0.00", "north", "f7"),
    ("E1", pseudonym("PID999"), "2026-06-01", "1.5", "vendor_C", "mixed"),
    ("E2", pseudonym("00123"), "2026-06-02", "0.00", "vendor_C", "mixed"),
    ("E4\nnext", pseudonym("7"), "2026-06-04", "2", "vendor_C", "mixed"),
    ("E5", pseudonym("8"), None, "0.00", "vendor_C", "mixed"),
    ("E6", pseudonym("9"), "2026-06-01", "1", "vendor_C", "bom"),
    ("E7", pseudonym("9"), "2026-06-01", "1", "X", "u1"),
    ("E8", pseudonym("9"), "2026-06-01", "1", "a__b", "u+1"),
    ("E10", pseudonym("00123"), "2026-06-01", "2", "D", "x1"),
    ("E11", pseudonym("5"), None, "0.00", "D", "x1"),
    ("E17", pseudonym("3"), "2026-03-01", "1", "D", "x5"),
    ("E18</record>", pseudonym("3"), "2026-03-01", "1", "D", "x5"),
}
XML_IDS = ("E10", "E11", "E17", "E18</record>")
FAILURES = {
    "south/south__vitals__20260302__bad.csv": "HEADER_CONTRACT",
    "south/south__vitals__20260302__gone.csv": "NO_VALID_ROWS",
    "south/south__vitals__20260302__latin.csv": "ENCODING",
    "novitals.csv": "NO_VENDOR",
    "D/D__vitals__2026__open.csv": "MALFORMED",
    "D/D__vitals__2026__empty.csv": "EMPTY",
    "D/D__vitals__2026__headonly.csv": "NO_VALID_ROWS",
    "D/D__vitals__2026__x2.XML": "HEADER_CONTRACT",
    "D/D__vitals__2026__x3.xml": "MALFORMED",
    "D/D__vitals__2026__x4.xml": "MALFORMED",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def silver_rows(spark, lake):
    columns = ENROLLMENT.silver_columns
    schema = ", ".join(f"{c} string" for c in columns)
    text = spark.read.options(header="true", multiLine="true", escape='"').schema(schema)
    small = text.csv(lake.silver("csv")).select(*columns)
    bulk = spark.read.schema(schema).parquet(lake.silver("parquet")).select(*columns)
    return small, bulk


@pytest.fixture(scope="module")
def ingested(spark, root, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    notified = spark.createDataFrame([(k,) for k in FILES], "object_key string")
    landing = Landing(root)
    outcomes = ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified)
    return lake, landing, notified, outcomes


def test_verdicts(ingested):
    rows = {r.object_key: r for r in ingested[3].collect()}
    assert set(rows) == set(FILES)
    assert {k: r.error for k, r in rows.items() if r.status == "failed"} == FAILURES
    assert rows["vendor_C/vendor_C__vitals__20260302__mixed.csv"].rows_seen == 5
    assert rows["vendor_C/vendor_C__vitals__20260302__mixed.csv"].rows_written == 4
    good = rows["north/north__vitals__20260302__f7.csv"]
    assert good.target == "silver/csv/batch_id=0"
    assert rows["D/D__vitals__2026__x1.xml"].target == "silver/parquet/batch_id=0"


def test_silver_rows(spark, ingested):
    small, bulk = silver_rows(spark, ingested[0])
    assert {tuple(r) for r in bulk.collect()} == {r for r in EXPECTED if r[0] in XML_IDS}
    assert {tuple(r) for r in small.unionByName(bulk).collect()} == EXPECTED


def test_quarantine_holds_the_raw_files(spark, ingested):
    lines = spark.read.text(f"{ingested[0].quarantine(0)}")
    kept = {r.file_name for r in lines.select("file_name").distinct().collect()}
    assert kept == set(FAILURES) - {"D/D__vitals__2026__empty.csv"}
    for key in kept:
        raw = FILES[key] if isinstance(FILES[key], bytes) else FILES[key].encode()
        copies = spark.read.format("binaryFile").load(f"{ingested[0].quarantine(0)}/file_name={key.replace('/', '%2F')}")
        assert [bytes(r.content) for r in copies.collect()] == [raw if raw.endswith(b"\n") else raw + b"\n"]


def test_repeating_a_batch_changes_nothing(spark, ingested):
    lake, landing, notified, outcomes = ingested
    again = ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified)
    assert sorted(map(str, again.collect())) == sorted(map(str, outcomes.collect()))
    small, bulk = silver_rows(spark, lake)
    assert small.count() + bulk.count() == len(EXPECTED)


def test_size_changes_no_row(spark, root, ingested, tmp_path):
    """Every file as a bulk file and every XML file as one to split: all verdicts and rows are equal."""
    lake = Lake(str(tmp_path / "lake"))
    landing = Landing(root, bulk_bytes=1, xml_split_bytes=1)
    outcomes = ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, ingested[2]).collect()

    def told(row):
        # How many records of a broken file can be told apart depends on the parser.
        return (row.object_key, row.status, row.error, row.rows_written, row.error != "MALFORMED" and row.rows_seen)

    assert sorted(map(str, map(told, outcomes))) == sorted(map(str, map(told, ingested[3].collect())))
    schema = ", ".join(f"{c} string" for c in ENROLLMENT.silver_columns)
    bulk = spark.read.schema(schema).parquet(lake.silver("parquet")).select(*ENROLLMENT.silver_columns)
    assert {tuple(r) for r in bulk.collect()} == EXPECTED


def test_lines_are_cut_alike_at_every_size(spark, tmp_path):
    """Lone CRs, CR line ends, both line ends, lines of blanks and empty lines, in both lanes."""
    rows = "E1,1,2026-06-01,1\nE2,2,2026-06-02,2\n"
    files = {
        "cell": HEADER + "E1,1,2026-06-01,a\rE9,P9,2026-06-01,2.0\nE2,2,2026-06-02,2\n",
        "cr": (HEADER + rows).replace("\n", "\r"),
        "crlf": (HEADER + rows).replace("\n", "\r\n"),
        "crlf_open": (HEADER + rows).replace("\n", "\r\n")[:-2],
        "crlf_end": (HEADER + rows).replace("\n", "\r\n")[:-1],
        "lf_then_crlf": HEADER + rows.replace("\n", "\r\n"),
        "crlf_then_lf": HEADER.replace("\n", "\r\n") + rows,
        "blanks_first": "  \n" + HEADER + rows,
        "blanks_inside": HEADER + "E1,1,2026-06-01,1\n  \nE2,2,2026-06-02,2\n",
        "empty_lines": "\n\r\n" + HEADER + "\n" + rows,
        "bom": "\ufeff\n" + HEADER + rows,
    }
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / f"v__vitals__1__{name}.csv").write_bytes(text.encode())
    told, read = [], []
    for landing in (Landing(str(tmp_path / "in")), Landing(str(tmp_path / "in"), bulk_bytes=1)):
        listed = list_files(spark, landing, ENROLLMENT).cache()
        told.append({r.lineage_file_uuid: r.reason for r in listed.collect()})
        found = read_landing(spark, landing, listed, ENROLLMENT).select("lineage_file_uuid", *ENROLLMENT.columns)
        read.append(sorted(map(repr, found.collect())))
        assert not any(r.whole for r in listed.collect())
    assert told[0] == told[1] == {name: "HEADER_CONTRACT" if name == "blanks_first" else None for name in files}
    assert read[0] == read[1]
    assert not any("encounter_id='E9'" in row for row in read[0])
    for name in ("cr", "crlf", "crlf_open", "lf_then_crlf", "crlf_then_lf", "bom"):
        assert sum(f"uuid='{name}'" in row and "gpa='2'" in row for row in read[0]) == 1, name


def test_safe_large_files_are_split(spark, root):
    landing = Landing(root, bulk_bytes=1, xml_split_bytes=1)
    whole = {r.object_key.rpartition("__")[2]: r.whole for r in list_files(spark, landing, ENROLLMENT).collect()}
    assert not whole["f7.csv"] and not whole["mixed.csv"] and not whole["x1.xml"]
    assert whole["x3.xml"] and whole["x5.xml"]


def test_objects_have_the_same_keys_however_the_root_is_spelled(spark, root, ingested):
    expected = {r.object_key for r in ingested[3].collect()}
    for spelled in (root + "/", f"file:{root}", f"file://{root}", f"{root}/../{root.rpartition('/')[2]}"):
        assert {r.object_key for r in Landing(spelled).files(spark).collect()} == expected


def test_a_root_that_recurs_below_itself(spark, tmp_path):
    inner = tmp_path / "in" / str(tmp_path)[1:] / "in"
    inner.mkdir(parents=True)
    (inner / "v__vitals__1__u.csv").write_text(HEADER)
    (tmp_path / "in" / "v__vitals__1__u.csv").write_text(HEADER)
    keys = {r.object_key for r in Landing(str(tmp_path / "in")).files(spark).collect()}
    assert keys == {"v__vitals__1__u.csv", f"{str(tmp_path)[1:]}/in/v__vitals__1__u.csv"}


def test_part_folders_are_an_option(spark, tmp_path):
    folder = tmp_path / "object=q"
    folder.mkdir()
    for name in ("v__vitals__1__a.csv", "v__vitals__1__b.csv"):
        (folder / name).write_text(HEADER + "E1,1,2026-06-01,3\n")
    assert Landing(str(tmp_path)).files(spark).select("object_key").distinct().count() == 2
    assert Landing(str(tmp_path), parts="object").files(spark).select("object_key").distinct().count() == 1


def test_delivered_again_in_another_batch(spark, root, ingested):
    lake, landing, notified, outcomes = ingested
    before = [spark.read.parquet(lake.silver("parquet")).count(), silver_rows(spark, lake)[0].count()]
    again = ingest_batch(spark, landing, lake, 1, ENROLLMENT, KEY, notified).collect()
    first = {r.object_key: r for r in outcomes.collect()}
    assert {r.object_key: (r.status, r.error) for r in again} == {k: (r.status, r.error) for k, r in first.items()}
    assert {r.object_key for r in again if r.redelivered} == {k for k, r in first.items() if r.status == "success"}
    assert [spark.read.parquet(lake.silver("parquet")).count(), silver_rows(spark, lake)[0].count()] == before


def test_a_changed_object_is_new(spark, tmp_path):
    lake, path = Lake(str(tmp_path / "lake")), tmp_path / "in" / "v__vitals__1__u.csv"
    path.parent.mkdir()
    for batch_id, line in enumerate(["E1,1,2026-06-01,3\n", "E1,1,2026-06-01,4.5\n"]):
        path.write_text(HEADER + line)
        found = ingest_batch(spark, Landing(str(path.parent)), lake, batch_id, ENROLLMENT, KEY).collect()
        assert [(r.status, r.redelivered) for r in found] == [("success", False)]
    assert ingest_batch(spark, Landing(str(path.parent)), lake, 2, ENROLLMENT, KEY).count() == 0
    assert silver_rows(spark, lake)[0].count() == 2


def test_a_batch_id_belongs_to_its_objects(spark, ingested, tmp_path):
    lake, landing, notified, _ = ingested
    (tmp_path / "other").mkdir()
    with pytest.raises(RuntimeError):
        ingest_batch(spark, Landing(str(tmp_path / "other")), lake, 0, ENROLLMENT, KEY, notified)
    with pytest.raises(RuntimeError):
        ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified.limit(2))


def test_quarantine_must_lie_outside(spark, root):
    from chartfold.sinks.quarantine import quarantine_files

    with pytest.raises(ValueError):
        quarantine_files(spark, Landing(root), None, f"{root}/dlq")


def test_pattern_selects_whole_paths(spark, tmp_path):
    for name in ("a_clean.csv", "a.csv", "a_clean.csv.bak"):
        with open(tmp_path / name, "w", newline="") as out:
            csv.writer(out).writerows([["x"], [name]])
    text = spark.read.option("header", "true").schema("x string").csv(str(tmp_path))
    assert [r.x for r in select_files_by_pattern(text, r".*_clean\.csv").collect()] == ["a_clean.csv"]


def test_an_empty_folder_is_an_empty_batch(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    lake = Lake(str(tmp_path / "lake"))
    outcomes = ingest_batch(spark, Landing(str(tmp_path / "landing")), lake, 0, ENROLLMENT, KEY)
    assert outcomes.count() == 0


def test_a_lost_attempt_is_taken_up_again(spark, root, ingested, tmp_path, monkeypatch):
    """Lost after the silver folders were written: the same silver files stay."""
    _, landing, notified, outcomes = ingested
    lake = Lake(str(tmp_path / "lake"))

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(ingest, "quarantine_files", lost)
        ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified)
    before = sorted(spark.read.parquet(lake.silver("parquet")).inputFiles())
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "list_files", lost)  # the raw files are not read again
        patch.setattr(ingest, "read_landing", lost)
        again = ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified)
    assert sorted(map(str, again.collect())) == sorted(map(str, outcomes.collect()))
    assert sorted(spark.read.parquet(lake.silver("parquet")).inputFiles()) == before
    small, bulk = silver_rows(spark, lake)
    assert {tuple(r) for r in small.unionByName(bulk).collect()} == EXPECTED


def test_many_notified_objects_are_found_by_listing(spark, root, ingested, tmp_path, monkeypatch):
    _, landing, notified, outcomes = ingested
    monkeypatch.setattr(ingest, "NAMED_OBJECTS", 0)
    lake = Lake(str(tmp_path / "lake"))
    again = ingest_batch(spark, landing, lake, 0, ENROLLMENT, KEY, notified)
    assert sorted(map(str, again.collect())) == sorted(map(str, outcomes.collect()))


def test_few_and_many_notified_objects_are_the_same_files(spark, tmp_path, monkeypatch):
    """Keys that name folders, hidden files, files outside or by a detour, parts, and none at all."""
    names = ("a/v__vitals__1__u.csv", "a/b/v__vitals__2__u.csv", "a/_tmp/v__vitals__3__u.csv", "a/.v__vitals__4__u.csv",
             "None", "object=q/v__vitals__5__u.csv", "object=q/v__vitals__6__u.csv", "q", "a/object=_p/v__vitals__7__u.csv")
    for name in (*(f"in/{name}" for name in names), "out/v__vitals__8__u.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(HEADER)
    keys = ["a", "", "a/", "a//v__vitals__1__u.csv", "b/../a/v__vitals__1__u.csv", "../out/v__vitals__8__u.csv", None,
            *names[1:4], names[5], "q", "a/_p", "gone"]
    notified = spark.createDataFrame([(k,) for k in keys], "object_key string")
    landing, found = Landing(str(tmp_path / "in"), parts="object"), []
    for most in (len(keys), 0):
        monkeypatch.setattr(ingest, "NAMED_OBJECTS", most)
        found.append(ingest._listing(spark, landing, notified).select(
            "object_key", "file_path", "file_size", "modified", "object_version").orderBy("file_path").collect())
    assert found[0] == found[1]
    assert sorted(r.object_key for r in found[0]) == ["a/_p", names[1], "q", "q", "q"]


def test_only_notified_objects_are_ingested(spark, root, tmp_path):
    keys = ["X/X__vitals__2026__u1.CSV", "a b/a__b__vitals__2026__u+1.csv", "gone/x__vitals__1__u.csv"]
    notified = spark.createDataFrame([(k,) for k in keys], "object_key string")
    lake = Lake(str(tmp_path / "lake"))
    found = ingest_batch(spark, Landing(root), lake, 0, ENROLLMENT, KEY, notified).collect()
    assert {r.object_key: r.error for r in found} == {
        keys[0]: None,
        keys[1]: None,
        keys[2]: "MISSING",
    }
    assert silver_rows(spark, lake)[0].count() == 2


def test_many_rejected_files_take_several_writes(spark, root, monkeypatch):
    from chartfold.sinks import quarantine

    monkeypatch.setattr(quarantine, "NAMED_FILES", 1)
    landing = Landing(root)
    rejected = list_files(spark, landing, ENROLLMENT).where("reason is not null")
    target = f"{root}-quarantine"
    assert quarantine.quarantine_files(spark, landing, rejected, target) == 4
    kept = {r.file_name for r in spark.read.text(target).select("file_name").distinct().collect()}
    assert kept == {"novitals.csv", "D/D__vitals__2026__open.csv", "south/south__vitals__20260302__bad.csv", "south/south__vitals__20260302__latin.csv"}


@pytest.mark.parametrize("split", [1, 1 << 30])
def test_fields_of_xml_records_by_path(spark, tmp_path, split):
    paths = {"encounter_id": "@nr", "patient_id": "patient/@id", "enrollment_date": "patient/since",
             "gpa": "terms/term[]/score[]"}
    contract = replace(ENROLLMENT, fields=tuple(replace(f, xml_path=paths[f.name]) for f in ENROLLMENT.fields))
    records = [
        '<record nr="X1"><patient id="007"><since>2026-01-02</since></patient>'
        "<terms><term><score>1</score><score> </score></term><term/><term><score>2.50</score></term></terms></record>",
        '<record nr="X2"><patient id="8"/><terms><term><score>3</score></term></terms></record>',
        '<record nr="X3"><patient><since>2026-01-04</since></patient></record>',
        '<record nr="X4"/>',
    ]
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "v__vitals__1__a.xml").write_text("<all>" + "\n".join(records) + "</all>")
    (landing / "v__vitals__2__flat.xml").write_text(
        "<all><record><encounter_id>X9</encounter_id><gpa>1</gpa></record></all>")
    where = Landing(str(landing), xml_split_bytes=split)
    files = list_files(spark, where, contract)
    rows = read_landing(spark, where, files, contract).collect()
    found = sorted((r.encounter_id, r.patient_id, r.enrollment_date, r.gpa, r.is_malformed) for r in rows if r.encounter_id)
    assert found == [
        ("X1", "007", "2026-01-02", "1,2.50", False),
        ("X2", "8", None, "3", False),
        ("X3", None, "2026-01-04", None, False),
        ("X4", None, None, None, False),
    ]


def test_a_filter_on_rows_parses_no_record_twice(spark, tmp_path):
    (tmp_path / "A__vitals__x__u.csv").write_text("gpa,encounter_id,patient_id,enrollment_date\n1,E1,P1,2024-01-01\n,E2,,\n")
    (tmp_path / "A__vitals__y__u.xml").write_text(
        "<records>" + "".join(f"<record><encounter_id>E{i}</encounter_id><patient_id>P{i}</patient_id>"
                              "<enrollment_date>d</enrollment_date><gpa>1</gpa></record>" for i in (3, 4)) + "</records>")
    landing = Landing(str(tmp_path), xml_split_bytes=1)
    files = list_files(spark, landing, ENROLLMENT)
    rows = read_landing(spark, landing, files, ENROLLMENT).where("trim(encounter_id) <> '' and trim(patient_id) <> ''")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.encounter_id for r in rows.collect()) == ["E1", "E3", "E4"]
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not [line for line in filters if "from_csv" in line or "from_xml" in line or "regexp_extract(value" in line]
