"""Queries over files: test tables are written out the way vendors and lanes deliver them."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.contracts import ENROLLMENT, VITALS, Contract
from chartfold.functions.paths import object_name
from chartfold.operators.cleaning import clean_rows
from chartfold.operators.history import scd2_rebuild
from chartfold.operators.quality import reject_empty_files, survivor_count
from chartfold.operators.routing import flatten_notifications, route_files
from chartfold.plans.ingest import Lake, ingest_batch
from chartfold.plans.queries import daily_history, order_messages
from chartfold.plans.views import FIXTURE_KEY, enrollment, staged_vitals, table
from chartfold.session import fresh_folder
from chartfold.sinks.history import history_layout
from chartfold.sinks.silver import write_silver_csv, write_silver_parquet
from chartfold.sources.landing import (
    Landing,
    list_files,
    read_landing,
    read_notifications,
    read_raw_text,
    stream_notifications,
)
from chartfold.sources.silver import read_silver_csv, read_silver_parquet, select_files_by_pattern
from chartfold.storage import exists, write_work_table
from chartfold.streaming.acknowledge import ingest_messages, read_acknowledged
from chartfold.streaming.fold import HistoryTable, fold_new_rows
from chartfold.streaming.staging import (
    append_staging,
    merge_lanes,
    read_staging,
    read_staging_rejects,
    stream_silver_csv,
    stream_silver_parquet,
)

SLICES = 3


def _object(extension: str) -> Column:
    """One landed object per vendor and month."""
    month = F.date_format("landed_on", "yyyyMM")
    return F.concat("source_vendor", F.lit("__vitals__"), month, F.lit("__u"), month, F.lit(extension))


def land_csv(spark: SparkSession, sf_dir: str) -> Landing:
    """Enrollments as CSV objects: vendor F permutes its columns and adds one, vendor P
    misnames the patient column.
    """
    root = fresh_folder(spark, "landing")
    rows = enrollment(spark, sf_dir).withColumn("object", _object(".csv"))
    shapes = {
        "vendor_O": ENROLLMENT.columns,
        "vendor_F": ["gpa", "patient_id", "row_number", "encounter_id", "enrollment_date"],
        "vendor_P": ["encounter_id", "patient", "enrollment_date", "gpa"],
    }
    for vendor, columns in shapes.items():
        mine = rows.where(F.col("source_vendor") == vendor).withColumn("patient", F.col("patient_id"))
        # Rebalancing gathers an object in few files and splits one that is too large.
        gathered = mine.select(*columns, "object").hint("rebalance", "object")
        writer = gathered.write.mode("append").partitionBy("object")
        writer.options(header="true", escape='"', ignoreLeadingWhiteSpace="false").option(
            "ignoreTrailingWhiteSpace", "false"
        ).csv(root)
    return Landing(root, parts="object")


def land_xml(spark: SparkSession, sf_dir: str) -> Landing:
    root = fresh_folder(spark, "landing")
    rows = enrollment(spark, sf_dir).withColumn("object", _object(".xml"))
    gathered = rows.select(*ENROLLMENT.columns, "object").hint("rebalance", "object")
    writer = gathered.write.partitionBy("object").format("xml")
    writer.options(rootTag="records", rowTag="record").save(root)
    return Landing(root, parts="object")


def _read_and_clean(spark: SparkSession, landing: Landing, contract: Contract = ENROLLMENT) -> DataFrame:
    listed = list_files(spark, landing, contract)
    files = write_work_table(listed, fresh_folder(spark, "files"))
    rows = read_landing(spark, landing, files, contract)
    cleaned = reject_empty_files(clean_rows(rows, contract, FIXTURE_KEY))
    return cleaned.select(*contract.silver_columns)


def q_contract_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all files with a good header, by column name whatever their order."""
    return _read_and_clean(spark, land_csv(spark, sf_dir))


def q_landing_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_and_clean(spark, land_xml(spark, sf_dir))


def q_ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(fresh_folder(spark, "lake"))
    outcomes = ingest_batch(spark, land_csv(spark, sf_dir), lake, 0, ENROLLMENT, FIXTURE_KEY)
    return outcomes.select("object_key", "status", "error", "rows_seen", "rows_written", "target")


def q_redelivered_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current versions after the same objects were notified in three batches, staged and folded each time."""
    return _redelivered(spark, sf_dir, Lake(fresh_folder(spark, "lake")))


def q_merged_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where each batch merges the ledger, so that later ones look objects up in buckets."""
    return _redelivered(spark, sf_dir, Lake(fresh_folder(spark, "lake"), merge_every=1))


def _redelivered(spark: SparkSession, sf_dir: str, lake: Lake) -> DataFrame:
    landing = land_csv(spark, sf_dir)
    named = landing.files(spark).select("object_key").distinct()
    history = HistoryTable(f"{lake.root}/history", ENROLLMENT)
    for batch_id in range(3):
        ingest_batch(spark, landing, lake, batch_id, ENROLLMENT, FIXTURE_KEY, named)
        # Objects of any size: the rows of large files are in the other silver folder.
        lanes = merge_lanes(
            stream_silver_csv(spark, lake.silver("csv"), ENROLLMENT),
            stream_silver_parquet(spark, lake.silver("parquet"), ENROLLMENT),
        )
        append_staging(lanes, f"{lake.root}/staging", f"{lake.root}/c1", ENROLLMENT).awaitTermination()
        fold_new_rows(spark, f"{lake.root}/staging", history, f"{lake.root}/c2").awaitTermination()
    columns = [c for c in ENROLLMENT.silver_columns if c != "lineage_file_uuid"]
    return history.history(spark).select(*columns, "is_current")


def land_odd_csv(spark: SparkSession, sf_dir: str) -> Landing:
    """Enrollments as text that mixes line ends, with line breaks, commas and quotes within quotes
    and lone CRs within cells."""
    root = fresh_folder(spark, "landing")
    rows = enrollment(spark, sf_dir).withColumn("object", _object(".csv"))
    key = F.col("row_number")
    note = (
        F.when(key % 3 == 0, F.concat(F.lit('"first\nsecond, ""'), key.cast("string"), F.lit('""\r\n\r\nthird"')))
        .when(key % 3 == 1, 'no "quote\ropens here').otherwise('""""')
    )
    date = F.when(key % 5 == 0, F.concat(F.lit('"'), F.col("enrollment_date"), F.lit('\r\n""late"", twice"'))).otherwise(
        F.col("enrollment_date"))
    line = F.concat_ws(",", note, "gpa", "patient_id", date, "encounter_id")
    end = F.when(key % 2 == 0, "\r").otherwise("")
    header = F.lit("note,gpa,patient_id,enrollment_date,encounter_id")
    lines = rows.select("object", key.alias("at"), F.concat(line, end).alias("value"))
    heads = rows.groupBy("object").agg(F.lit(-1).cast("bigint").alias("at")).select(
        "object", "at", F.concat(header, F.when(F.contains("object", F.lit("_F_")), "\r").otherwise("")).alias("value"))
    ordered = lines.unionByName(heads).repartition("object").sortWithinPartitions("object", "at")
    ordered.select("value", "object").write.partitionBy("object").option("lineSep", "\n").text(root)
    return Landing(root, parts="object")


def q_mixed_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of such files, read as small and as bulk files."""
    landing = land_odd_csv(spark, sf_dir)
    small, bulk = (_read_and_clean(spark, each) for each in (landing, replace(landing, bulk_bytes=1)))
    return small.withColumn("lane", F.lit("small")).unionByName(bulk.withColumn("lane", F.lit("bulk")))


class _DriverLost(Exception):
    pass


def _lost_after_each_step():
    """Hears of the steps of an ingest batch, and is lost after each that it did not hear of before."""
    behind = set()

    def on_step(step: str) -> None:
        if step not in behind:
            behind.add(step)
            raise _DriverLost

    return on_step


def q_interrupted_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of one batch whose driver is lost after its first step, then after its second, and
    so on; what has reached silver by then is staged and folded each time."""
    lake = Lake(fresh_folder(spark, "lake"))
    landing = land_csv(spark, sf_dir)
    history = HistoryTable(f"{lake.root}/history", ENROLLMENT)

    def fold_silver() -> None:
        silver = stream_silver_csv(spark, lake.silver("csv"), ENROLLMENT)
        append_staging(silver, f"{lake.root}/staging", f"{lake.root}/c1", ENROLLMENT).awaitTermination()
        fold_new_rows(spark, f"{lake.root}/staging", history, f"{lake.root}/c2").awaitTermination()

    on_step = _lost_after_each_step()
    while True:
        try:
            ingest_batch(spark, landing, lake, 0, ENROLLMENT, FIXTURE_KEY, on_step=on_step)
        except _DriverLost:
            if exists(spark, lake.silver("csv")):
                fold_silver()
        else:
            break
    columns = [c for c in ENROLLMENT.silver_columns if c != "lineage_file_uuid"]
    return history.history(spark).select(*columns, "is_current")


def q_bulk_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all files with a good header, read by the bulk lane as if every file were large."""
    return _read_and_clean(spark, replace(land_csv(spark, sf_dir), bulk_bytes=1))


def q_split_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all XML files, cut at record ends as if every file were large."""
    return _read_and_clean(spark, replace(land_xml(spark, sf_dir), xml_split_bytes=1))


NESTED = replace(ENROLLMENT, fields=tuple(
    replace(f, xml_path={"patient_id": "patient/@id", "enrollment_date": "patient/stay/since",
                         "gpa": "patient/stay/score[]"}.get(f.name)) for f in ENROLLMENT.fields))


def land_nested_xml(spark: SparkSession, sf_dir: str) -> Landing:
    """Enrolments with the patient's id as an attribute and scores as repeated children of a child."""
    root = fresh_folder(spark, "landing")
    rows = enrollment(spark, sf_dir).withColumn("object", _object(".xml"))
    stay = F.struct(F.col("enrollment_date").alias("since"), F.array_compact(F.array("gpa", "gpa")).alias("score"))
    patient = F.struct(F.col("patient_id").alias("_id"), stay.alias("stay")).alias("patient")
    gathered = rows.select("encounter_id", patient, "object").hint("rebalance", "object")
    writer = gathered.write.partitionBy("object").format("xml")
    writer.options(rootTag="records", rowTag="record").save(root)
    return Landing(root, parts="object")


def q_nested_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of records with nested fields, read whole and cut at record ends."""
    landing = land_nested_xml(spark, sf_dir)
    lanes = {"whole": landing, "split": replace(landing, xml_split_bytes=1)}
    read = [_read_and_clean(spark, of, NESTED).withColumn("lane", F.lit(lane)) for lane, of in lanes.items()]
    return read[0].unionByName(read[1])


def q_acknowledged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two messages a month: one names the objects of two vendors, one that of vendor P, which fails."""
    landing = land_csv(spark, sf_dir)
    lake = Lake(fresh_folder(spark, "lake"))
    folder = fresh_folder(spark, "messages")
    keys = landing.files(spark).select("object_key").distinct()
    month = F.regexp_extract("object_key", r"__vitals__(\d+)__", 1)
    bad = F.startswith("object_key", F.lit("vendor_P"))
    record = F.struct(F.struct(
        F.struct(F.lit("clinic-bronze").alias("name")).alias("bucket"),
        F.struct(F.url_encode("object_key").alias("key"), F.lit(1).cast("long").alias("size")).alias("object"),
    ).alias("s3"))
    messages = keys.groupBy(F.concat(F.when(bad, "p").otherwise("g"), month).alias("receipt")).agg(
        F.to_json(F.struct(F.collect_list(record).alias("Records"))).alias("body"))
    messages.write.json(folder)
    ingest_messages(spark, stream_notifications(spark, folder), landing, lake, ENROLLMENT, FIXTURE_KEY,
                    f"{lake.root}/c0", "clinic-bronze").awaitTermination()
    return read_acknowledged(spark, lake).drop("batch_id")


def q_ingest_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one ingest batch leaves in the silver folder of the small lane."""
    lake = Lake(fresh_folder(spark, "lake"))
    ingest_batch(spark, land_csv(spark, sf_dir), lake, 0, ENROLLMENT, FIXTURE_KEY)
    return read_silver_csv(spark, lake.silver("csv"), ENROLLMENT).drop("cast_errors")


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of the rejected files. An object in several parts has a header line in each."""
    lake = Lake(fresh_folder(spark, "lake"))
    ingest_batch(spark, land_csv(spark, sf_dir), lake, 0, ENROLLMENT, FIXTURE_KEY)
    lines = spark.read.text(lake.quarantine(0)).select("file_name", "value")
    header = F.col("value").like("%gpa%")
    return lines.where(~header).unionByName(lines.where(header).distinct())


def q_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per landed object, and its different header lines; each part has one."""
    lines = read_raw_text(spark, land_csv(spark, sf_dir).root)
    header = F.col("value").like("%gpa%")
    return lines.groupBy(object_name("file_path", "object").alias("object")).agg(
        F.count_if(~header).alias("lines"), F.count_distinct(F.when(header, F.col("value"))).alias("headers"))


def q_select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files whose path names vendor F and the first half of a year."""
    columns = ["gpa", "patient_id", "row_number", "encounter_id", "enrollment_date"]
    landed = (
        spark.read.options(header="true", recursiveFileLookup="true")
        .schema(", ".join(f"{c} string" for c in columns))
        .csv(land_csv(spark, sf_dir).root)
    )
    wanted = select_files_by_pattern(landed, r".*vendor_F__vitals__\d{4}0[1-6]__.*\.csv")
    return wanted.select("encounter_id", "enrollment_date")


def q_silver_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files, one of them with its columns the other way round."""
    folder = fresh_folder(spark, "silver")
    rows = staged_vitals(spark, sf_dir)
    turned = F.col("source_vendor").isin("click", "view")
    write_silver_csv(rows.where(~turned), folder, 0, VITALS)
    other = rows.where(turned).select(*reversed(VITALS.silver_columns))
    other.write.options(header="true", escape='"').csv(f"{folder}/batch_id=1")
    return read_silver_csv(spark, folder, VITALS).drop("cast_errors")


def q_silver_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "silver")
    write_silver_parquet(staged_vitals(spark, sf_dir), folder, 0, VITALS)
    return read_silver_parquet(spark, folder, VITALS).drop("cast_errors")


def q_survivor_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that one write of the cleaned rows observes on its way."""
    landed = enrollment(spark, sf_dir).withColumn("lineage_file_uuid", F.lit("u"))
    rows, totals = survivor_count(clean_rows(landed, ENROLLMENT, FIXTURE_KEY))
    write_work_table(rows, fresh_folder(spark, "rows"))
    return spark.createDataFrame(
        [(totals.get["rows_seen"], totals.get["rows_written"])],
        "rows_seen bigint, rows_written bigint",
    )


def _saved_messages(spark: SparkSession, sf_dir: str) -> str:
    folder = fresh_folder(spark, "messages")
    order_messages(spark, sf_dir).write.json(folder)
    return folder


def q_read_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_notifications(spark, _saved_messages(spark, sf_dir))
    return route_files(flatten_notifications(messages), bulk_bytes=250_000)


def q_stream_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same routes from a stream over the message folder."""
    messages = stream_notifications(spark, _saved_messages(spark, sf_dir))
    routes = route_files(flatten_notifications(messages), bulk_bytes=250_000)
    target = fresh_folder(spark, "routes")
    query = (
        routes.writeStream.format("parquet")
        .option("checkpointLocation", f"{target}-checkpoint")
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(routes.schema).parquet(target)


def q_merge_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings split over both silver lanes and staged by one stream."""
    lake = fresh_folder(spark, "lake")
    rows = staged_vitals(spark, sf_dir)
    in_bulk = F.col("source_vendor").isin("click", "view")
    write_silver_csv(rows.where(~in_bulk), f"{lake}/csv", 0, VITALS)
    write_silver_parquet(rows.where(in_bulk), f"{lake}/parquet", 0, VITALS)
    lanes = merge_lanes(
        stream_silver_csv(spark, f"{lake}/csv", VITALS),
        stream_silver_parquet(spark, f"{lake}/parquet", VITALS, rows.schema),
    )
    append_staging(lanes, f"{lake}/staging", f"{lake}/checkpoint", VITALS).awaitTermination()
    return read_staging(spark, f"{lake}/staging", VITALS).drop("ingested_at")


def _slices(rows: DataFrame) -> list[Column]:
    """Equal spans of load time, as conditions that Spark pushes into the scan."""
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    if first is None:
        return []
    microsecond = timedelta(microseconds=1)
    span = (last - first) // microsecond
    cuts = [first + span * i // SLICES * microsecond for i in range(1, SLICES)]
    loaded = F.col("ingested_at")
    bounds = [None, *cuts, None]
    conditions = []
    for low, high in zip(bounds, bounds[1:]):
        # Zone-less literals, or Spark would convert the column and push nothing down.
        tests = [loaded >= F.lit(low.isoformat()).cast("timestamp_ntz")] if low else []
        tests += [loaded < F.lit(high.isoformat()).cast("timestamp_ntz")] if high else []
        conditions.append(reduce(Column.__and__, tests))
    return conditions


def q_scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after folding three batches one by one."""
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(fresh_folder(spark, "history"), compact_every=2)
    for number, condition in enumerate(_slices(rows)):
        history.fold(spark, rows.where(condition), number, "scd2_apply")
    return history.history(spark)


def q_fold_every_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all arrivals, folded in three batches: the cuts leave no trace."""
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(fresh_folder(spark, "history"), compact_every=2, keep_all=True)
    for number, condition in enumerate(_slices(rows)):
        history.fold(spark, rows.where(condition), number, "fold_every_arrival")
    return history.history(spark)


def q_replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch is delivered twice: once more under its number, and again under the next."""
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(fresh_folder(spark, "history"), compact_every=2)
    for number, condition in enumerate(_slices(rows)):
        batch = rows.where(condition)
        for batch_id in (2 * number, 2 * number, 2 * number + 1):
            history.fold(spark, batch, batch_id, "replayed_batches")
    return history.history(spark)


def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first slice of time arrives after the second; what it cannot change is late."""
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(fresh_folder(spark, "history"))
    slices = _slices(rows)
    for number, condition in enumerate([slices[1], slices[0], slices[2]]):
        history.fold(spark, rows.where(condition), number, "late_rows")
    return history.late(spark)


def q_skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings reduced to warm or not; only a change of that opens a version."""
    warm = staged_vitals(spark, sf_dir).withColumns(
        {
            "heart_rate": (F.col("temperature") > 25).cast("bigint"),
            "blood_pressure": F.lit(""),
            "temperature": F.lit(0.0),
            "source_vendor": F.lit("one"),
        }
    )
    history = HistoryTable(fresh_folder(spark, "history"), skip_unchanged=True)
    for number, condition in enumerate(_slices(warm)):
        history.fold(spark, warm.where(condition), number, "skip_unchanged")
    return history.history(spark)


def q_history_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History written in its layout and read back."""
    return write_work_table(history_layout(daily_history(spark, sf_dir), VITALS), fresh_folder(spark, "layout"))


def q_staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a unit in a number column, as staging sets them aside."""
    rate = F.col("value").cast("string")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("encounter_id"),
        F.when(F.col("event_id") % 10 == 0, F.concat(rate, F.lit(" bpm"))).otherwise(rate).alias("heart_rate"),
        F.col("value").alias("temperature"),
    )
    lake = fresh_folder(spark, "lake")
    rows.write.parquet(f"{lake}/silver")
    silver = stream_silver_parquet(spark, f"{lake}/silver", VITALS, rows.schema)
    append_staging(silver, f"{lake}/staging", f"{lake}/checkpoint", VITALS).awaitTermination()
    rejects = read_staging_rejects(spark, f"{lake}/staging", VITALS)
    return rejects.select(
        "encounter_id", "heart_rate", "temperature", F.array_join("cast_errors", ",").alias("cast_errors")
    )


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[HistoryTable, str]:
    """Each slice arrives as silver files, is staged and folded: the history and the staging folder."""
    lake = fresh_folder(spark, "lake")
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(f"{lake}/history")
    for number, condition in enumerate(_slices(rows)):
        rows.where(condition).write.parquet(f"{lake}/silver/batch_id={number}")
        silver = stream_silver_parquet(spark, f"{lake}/silver", VITALS, rows.schema)
        append_staging(silver, f"{lake}/staging", f"{lake}/staging-checkpoint", VITALS).awaitTermination()
        fold_new_rows(spark, f"{lake}/staging", history, f"{lake}/fold-checkpoint").awaitTermination()
    return history, f"{lake}/staging"


def q_stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history from streams."""
    return _streamed(spark, sf_dir)[0].history(spark)


def q_rebuild_from_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of these streams once more, from staging alone and the fold's own cuts."""
    history, staging = _streamed(spark, sf_dir)
    return scd2_rebuild(history.folded_staging(spark, staging), "batch_id")


def q_read_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active versions as the folded table keeps them, without reading closed ones."""
    rows = staged_vitals(spark, sf_dir)
    history = HistoryTable(fresh_folder(spark, "history"), compact_every=2)
    for number, condition in enumerate(_slices(rows)):
        history.fold(spark, rows.where(condition), number, "read_current")
    return history.current(spark)


QUERIES = {
    "contract_gate": q_contract_gate,
    "landing_xml": q_landing_xml,
    "ingest_outcomes": q_ingest_outcomes,
    "ingest_silver": q_ingest_silver,
    "redelivered_objects": q_redelivered_objects,
    "merged_ledger": q_merged_ledger,
    "interrupted_batch": q_interrupted_batch,
    "bulk_csv": q_bulk_csv,
    "mixed_line_ends": q_mixed_line_ends,
    "split_xml": q_split_xml,
    "nested_xml": q_nested_xml,
    "acknowledged_messages": q_acknowledged_messages,
    "quarantine": q_quarantine,
    "raw_text": q_raw_text,
    "select_files_by_pattern": q_select_files,
    "silver_csv_roundtrip": q_silver_csv_roundtrip,
    "silver_parquet_roundtrip": q_silver_parquet_roundtrip,
    "survivor_count": q_survivor_count,
    "read_notifications": q_read_notifications,
    "stream_notifications": q_stream_notifications,
    "merge_lanes": q_merge_lanes,
    "scd2_apply": q_scd2_apply,
    "stream_fold": q_stream_fold,
    "rebuild_from_staging": q_rebuild_from_staging,
    "fold_every_arrival": q_fold_every_arrival,
    "replayed_batches": q_replayed_batches,
    "late_rows": q_late_rows,
    "skip_unchanged": q_skip_unchanged,
    "history_layout": q_history_layout,
    "staging_rejects": q_staging_rejects,
    "read_current_versions": q_read_current,
}
