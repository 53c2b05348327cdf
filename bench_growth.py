"""Measurements that one query cannot show; prints one JSON line each.

``fold``: seconds per batch while the history grows. Every batch brings the same number of
readings, half of them for keys the history knows, half for new ones.
``lookup``: seconds per batch of a few random keys, over a small and a large history.
``landing``: files per second through one ingest batch of many small CSV files whose
headers differ in order.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from chartfold.contracts import ENROLLMENT
from chartfold.plans.ingest import Lake, ingest_batch
from chartfold.plans.views import FIXTURE_KEY, staged_vitals, table
from chartfold.session import fresh_folder, local_session
from chartfold.sources.landing import Landing
from chartfold.streaming.fold import HistoryTable


def fold_growth(spark, sf_dir: str, batches: int = 25) -> dict:
    rows = staged_vitals(spark, sf_dir)
    path = fresh_folder(spark, "rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    count = rows.count()
    history = HistoryTable(fresh_folder(spark, "history"), compact_every=12)
    seconds = []
    for number in range(batches):
        # Each reading becomes a key of its own; half of the keys move on with each batch.
        serial = F.monotonically_increasing_id()
        moved = F.when(serial % 2 == 0, serial).otherwise(serial + number * 10_000_000)
        batch = rows.withColumns(
            {
                "encounter_id": F.concat(F.lit("E"), moved),
                "ingested_at": F.col("ingested_at") + F.make_dt_interval(F.lit(40 * number)),
            }
        )
        started = time.perf_counter()
        history.fold(spark, batch, number, "growth")
        seconds.append(round(time.perf_counter() - started, 2))
    current = history.current(spark).count()
    return {"rows_per_batch": count, "current_rows": current, "seconds": seconds}


def lookup(spark, sf_dir: str, copies: tuple[int, ...] = (10, 50), keys: int = 100, buckets: int = 64) -> dict:
    """The keys of a batch lie anywhere among all keys, so that their span spares nothing."""
    rows = staged_vitals(spark, sf_dir)
    path = fresh_folder(spark, "rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    found = {}
    for times in copies:
        copied = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
        keyed = copied.withColumn("encounter_id", F.concat(F.lit("E"), F.monotonically_increasing_id())).drop("copy")
        history = HistoryTable(fresh_folder(spark, "history"), compact_every=1, compact_share=0.5, buckets=buckets)
        history.fold(spark, keyed, 0, "lookup")
        known = history.current(spark).select("encounter_id").orderBy(F.xxhash64("encounter_id")).limit(keys).collect()
        seconds = []
        for number in range(1, 5):
            some = [k.encounter_id for k in known[: keys if number % 2 else 1]]
            batch = rows.limit(len(some)).withColumn("encounter_id", F.explode(F.array(*map(F.lit, some)))).withColumn(
                "ingested_at", F.col("ingested_at") + F.make_dt_interval(F.lit(400 * number)))
            started = time.perf_counter()
            history.fold(spark, batch, number, "lookup")
            seconds.append(round(time.perf_counter() - started, 2))
        found[history.current(spark).count()] = {f"{keys}_keys": seconds[0::2], "one_key": seconds[1::2]}
    return {"seconds_by_rows": found}


def landing_rate(spark, sf_dir: str, files: int = 2000) -> dict:
    """The files are written in plain Python: their names and number are the point here."""
    rows = table(spark, sf_dir, "orders").limit(20).collect()
    root = Path(tempfile.mkdtemp(prefix="chartfold-landing-"))
    orders = (ENROLLMENT.columns, ENROLLMENT.columns[::-1], [*ENROLLMENT.columns[1:], "encounter_id"])
    for number in range(files):
        columns = orders[number % len(orders)]
        lines = [",".join(columns)]
        for row in rows:
            cells = {
                "encounter_id": f"{row.o_orderkey}-{number}",
                "patient_id": f"P{row.o_custkey}",
                "enrollment_date": f"{row.o_orderdate:%Y-%m-%d}",
                "gpa": "3.5",
            }
            lines.append(",".join(cells[c] for c in columns))
        name = f"vendor{number % 7}__vitals__20260614__u{number}.csv"
        (root / name).write_text("\n".join(lines) + "\n")
    seconds = []
    for number in range(2):
        lake = Lake(fresh_folder(spark, "lake"))
        started = time.perf_counter()
        outcomes = ingest_batch(spark, Landing(str(root)), lake, 0, ENROLLMENT, FIXTURE_KEY)
        seconds.append(time.perf_counter() - started)
        assert outcomes.where("status = 'success'").count() == files
    return {"files": files, "seconds": round(min(seconds), 2), "files_per_second": round(files / min(seconds))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "chartfold-growth")
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[1:] or ["fold", "lookup", "landing"]:
        measure = {"fold": fold_growth, "lookup": lookup, "landing": landing_rate}[name]
        print(json.dumps({"measurement": name, **measure(spark, sf_dir)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
