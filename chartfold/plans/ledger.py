"""Which objects were ingested, and in which state: recent batches, and all earlier ones in buckets.

Below the root of a ledger::

    recent/batch_id=N                     what batch N ingested
    merged/version=V,buckets=M/bucket=B   what earlier batches ingested, by hash of the object's state

A batch looks its objects up in the recent folders, whose number is bounded, and in the buckets
that its objects hash to; no other bucket is listed or opened. Recent folders are merged once there
are ``merge_every`` of them and they hold ``merge_share`` of the merged rows, so that the work of
rewriting stays in proportion to what came, or once there are ``most_recent``. Only the batch that
holds the claim of its lake reads or writes here.

A batch records itself before its outcomes show, and a lookup leaves out the rows of its own id, so
that a batch may be repeated after a loss at any step; only that batch could have left its folder
unfinished, since the claim stays with it. A merge that was lost has no mark and is
written again; recent folders that a lost merge left behind repeat rows of the merged ones, which
changes no lookup.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.storage import child_names, complete, delete, is_complete, write_work_table

STATE = ["object_key", "object_version"]
ENTRY = "object_key string, object_version string, rows_seen bigint, rows_written bigint, target string"
_ENTRY_COLUMNS = [c.split()[0] for c in ENTRY.split(", ")]


@dataclass(frozen=True)
class Ledger:
    root: str
    buckets: int = 64
    merge_every: int = 64
    merge_share: float = 0.1
    most_recent: int = 256

    def _recent_path(self, batch_id: int) -> str:
        return f"{self.root}/recent/batch_id={batch_id}"

    def _recent_ids(self, spark: SparkSession) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in child_names(spark, f"{self.root}/recent"))

    def _recent(self, spark: SparkSession, ids: list[int]) -> DataFrame:
        paths = [self._recent_path(i) for i in ids]
        reader = spark.read.schema(f"{ENTRY}, batch_id bigint").option("basePath", f"{self.root}/recent")
        return reader.parquet(*paths).select(*_ENTRY_COLUMNS, "batch_id")

    def _merged(self, spark: SparkSession) -> tuple[int, int, str] | None:
        """Version, number of buckets and folder of the last finished merge."""
        found = []
        for name in child_names(spark, f"{self.root}/merged"):
            version, buckets = (int(part.split("=")[1]) for part in name.split(","))
            path = f"{self.root}/merged/{name}"
            if is_complete(spark, path):
                found.append((version, buckets, path))
        return max(found, default=None)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*STATE), F.lit(buckets)).cast("int")

    def _from_buckets(self, spark: SparkSession, path: str, only: set[int] | None = None) -> DataFrame | None:
        held = {int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("bucket=")}
        paths = [f"{path}/bucket={b}" for b in sorted(held if only is None else held & only)]
        if not paths:
            return None
        return spark.read.schema(f"{ENTRY}, batch_id bigint").parquet(*paths)

    def lookup(self, spark: SparkSession, states: DataFrame, batch_id: int) -> DataFrame:
        """What other batches than this one ingested of some object states, one row per state."""
        wanted = states.select(*STATE).distinct()
        found = spark.createDataFrame([], f"{ENTRY}, batch_id bigint")
        merged = self._merged(spark)
        if merged:
            _, buckets, path = merged
            touched = {row.bucket for row in wanted.select(self._bucket(buckets).alias("bucket")).distinct().collect()}
            rows = self._from_buckets(spark, path, touched)
            found = rows if rows is not None else found
        recent = [i for i in self._recent_ids(spark) if i != batch_id]
        if recent:
            found = found.unionByName(self._recent(spark, recent))
        others = found.where(F.col("batch_id") != batch_id).join(wanted, STATE, "left_semi")
        return others.groupBy(*STATE).agg(*[F.min(c).alias(c) for c in ("rows_seen", "rows_written", "target")])

    def record(self, outcomes: DataFrame, batch_id: int) -> None:
        """What a batch ingested itself; written before its outcomes show."""
        rows = outcomes.where((F.col("status") == "success") & ~F.col("redelivered"))
        write_work_table(rows.select(*_ENTRY_COLUMNS), self._recent_path(batch_id))

    def _is_due(self, spark: SparkSession, recent: list[int], merged: str | None) -> bool:
        if len(recent) >= self.most_recent or (len(recent) >= self.merge_every and not merged):
            return True
        if len(recent) < self.merge_every or len(recent) % self.merge_every:
            return False
        before = self._from_buckets(spark, merged)
        held = before.count() if before is not None else 0
        return self._recent(spark, recent).count() >= held * self.merge_share

    def merge(self, spark: SparkSession) -> None:
        """Merge the recent folders if that is due; a state that several batches name stays once."""
        recent, last = self._recent_ids(spark), self._merged(spark)
        if not recent or not self._is_due(spark, recent, last[2] if last else None):
            return
        rows = self._recent(spark, recent)
        before = self._from_buckets(spark, last[2]) if last else None
        if before is not None:
            rows = before.unionByName(rows)
        least = [F.min(c).alias(c) for c in (*_ENTRY_COLUMNS[len(STATE):], "batch_id")]
        bucketed = rows.groupBy(*STATE).agg(*least).withColumn("bucket", self._bucket(self.buckets))
        path = f"{self.root}/merged/version={last[0] + 1 if last else 0},buckets={self.buckets}"
        bucketed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        complete(spark, path)
        if last:
            delete(spark, last[2])
        for batch_id in recent:
            delete(spark, self._recent_path(batch_id))
