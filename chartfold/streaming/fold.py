"""The incremental type-2 history: batches of staging rows folded into Parquet folders.

Below the root of a history table::

    delta/batch_id=N/kind=…      what batch N opened, closed, or found late
    base/version=N/bucket=B      active versions after batch N of the keys that hash to B
    buckets/version=N            which version of base holds which bucket as of base N
    settled/version=N/kind=…     closed and late rows of the deltas that base N replaces
    cuts/batch_id=N              staging files whose rows batch N took
    unusable/batch_id=N          rows without key or load time
    commits/batch_id=N           written last; what it does not name does not count

A batch looks up the active versions of its own keys, in the buckets that they hash to, and
writes only what it changes. Now and then the deltas are merged into a new base: once they hold a
fair share of its rows, so that the work of rewriting it stays in proportion to what arrived.
Only buckets that the deltas touch are written again; a new base names the others where they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chartfold.contracts import VITALS, Contract
from chartfold.operators.history import (
    chain_distinct,
    closed_version,
    dedup_latest,
    join_active,
    opened_version,
)
from chartfold.sinks.history import history_layout
from chartfold.storage import child_names, complete, delete, is_complete, write_work_table
from chartfold.streaming.staging import STAGED_IN, read_staging, staged_in, staging_changes

_BUCKETS = "bucket int, version bigint, modulus int"
_COMMIT = "stream_id string, base_version bigint, base_rows bigint, delta_rows bigint"


@dataclass(frozen=True)
class HistoryTable:
    """A history below ``root``. With ``skip_unchanged``, equal values open no version; with
    ``keep_all``, every arrival opens one, and not only the latest of its key in a batch, so
    that it does not matter where a stream that comes in order is cut into batches.

    Deltas are merged once there are ``compact_every`` of them and they opened
    ``compact_share`` of the rows in the base, or once there are ``most_deltas``. The base has
    ``buckets`` folders; another number takes effect with the next base, which writes all of it.
    """

    root: str
    contract: Contract = VITALS
    compact_every: int = 12
    compact_share: float = 0.1
    most_deltas: int = 480
    skip_unchanged: bool = False
    keep_all: bool = False
    buckets: int = 16

    # Reading

    def _commit_path(self, batch_id: int) -> str:
        return f"{self.root}/commits/batch_id={batch_id}"

    def _commit(self, spark: SparkSession, batch_id: int) -> Row | None:
        path = self._commit_path(batch_id)
        return spark.read.schema(_COMMIT).json(path).first() if is_complete(spark, path) else None

    def committed_batches(self, spark: SparkSession) -> list[int]:
        names = child_names(spark, f"{self.root}/commits")
        found = sorted(int(n.split("=")[1]) for n in names)
        while found and not is_complete(spark, self._commit_path(found[-1])):
            found.pop()
        return found

    def _state(self, spark: SparkSession) -> tuple[int, int]:
        """Base version and last batch; -1 where there is none."""
        batches = self.committed_batches(spark)
        if not batches:
            return -1, -1
        return self._commit(spark, batches[-1]).base_version, batches[-1]

    def _empty(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """No rows, in a form that the optimizer removes from joins and unions."""
        fields = (schema or self.contract.history_schema()).fields
        nothing = spark.range(1).where("false")
        return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    def _bucket(self, modulus: int) -> Column:
        return F.pmod(F.xxhash64(*self.contract.key), F.lit(modulus)).cast("int")

    def _places(self, spark: SparkSession, version: int) -> tuple[int, dict[int, int]]:
        """The number of buckets of a base, and the version that holds each that has rows."""
        if version < 0:
            return self.buckets, {}
        rows = spark.read.schema(_BUCKETS).json(f"{self.root}/buckets/version={version}").collect()
        return rows[0].modulus, {row.bucket: row.version for row in rows if row.bucket is not None}

    def _base(self, spark: SparkSession, version: int, only: set[int] | None = None) -> DataFrame:
        """Rows of a base, or of some of its buckets; no other bucket is listed or opened."""
        _, places = self._places(spark, version)
        held = sorted((b, v) for b, v in places.items() if only is None or b in only)
        if not held:
            return self._empty(spark)
        names = self.contract.history_schema().names
        paths = [f"{self.root}/base/version={v}/bucket={b}" for b, v in held]
        return spark.read.schema(self.contract.history_schema()).parquet(*paths).select(*names)

    def _delta(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """Delta rows of a run of batches, at most as many as lie between two bases."""
        schema = self.contract.history_schema().add("kind", "string")
        paths = [f"{self.root}/delta/batch_id={n}" for n in range(after + 1, upto + 1)]
        if not paths:
            return self._empty(spark, schema)
        reader = spark.read.schema(schema).option("basePath", f"{self.root}/delta")
        return reader.parquet(*paths).select(*schema.names)

    def _settled(self, spark: SparkSession, version: int, kind: str) -> DataFrame:
        if version < 0:
            return self._empty(spark)
        schema = self.contract.history_schema().add("kind", "string").add("version", "long")
        rows = spark.read.schema(schema).parquet(f"{self.root}/settled")
        wanted = rows.where((F.col("version") <= version) & (F.col("kind") == kind))
        return wanted.drop("version", "kind")

    def _active(self, spark: SparkSession, base: int, upto: int, only: set[int] | None = None) -> DataFrame:
        """Active versions: those of the deltas, and those of the base for all other keys, or, of
        the base, for other keys of some buckets."""
        keys = list(self.contract.key)
        opened = self._delta(spark, base, upto).where("kind = 'open'").drop("kind")
        # One batch opens one version of a key that stays active.
        newest = opened if upto - base == 1 else dedup_latest(opened, keys, "start_time")
        if base < 0:
            return newest
        kept = self._base(spark, base, only).join(opened.select(*keys), keys, "left_anti")
        return kept.unionByName(newest)

    def current(self, spark: SparkSession) -> DataFrame:
        return self._active(spark, *self._state(spark))

    def _ended(self, spark: SparkSession, kind: str) -> DataFrame:
        base, upto = self._state(spark)
        recent = self._delta(spark, base, upto).where(F.col("kind") == kind).drop("kind")
        return self._settled(spark, base, kind).unionByName(recent)

    def history(self, spark: SparkSession) -> DataFrame:
        """All versions, active and closed."""
        return self._ended(spark, "closed").unionByName(self.current(spark))

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that were older than the active version of their key when they came."""
        return self._ended(spark, "late")

    def folded_staging(self, spark: SparkSession, staging: str) -> DataFrame:
        """Usable staging rows that committed batches took, each with the ``batch_id`` of its batch.

        With it, ``scd2_rebuild`` cuts the log as the fold did, whatever the size of its batches.
        """
        rows = read_staging(spark, staging, self.contract, staged_in()).where(self._usable())
        if not child_names(spark, f"{self.root}/cuts"):
            return rows.where("false").drop(STAGED_IN).withColumn("batch_id", F.lit(None).cast("bigint"))
        cuts = spark.read.schema(f"{STAGED_IN} string, batch_id bigint").parquet(f"{self.root}/cuts")
        _, upto = self._state(spark)
        return rows.join(cuts.where(F.col("batch_id") <= upto), STAGED_IN).drop(STAGED_IN)

    # Folding

    def _usable(self) -> Column:
        return reduce(Column.__and__, [F.col(c).isNotNull() for c in [*self.contract.key, "ingested_at"]])

    def _check(self, spark: SparkSession, batch_id: int, stream_id: str) -> Row | None:
        """Commit to fold onto, or None if the batch is committed already."""
        commit = self._commit(spark, batch_id)
        before = commit or (self._commit(spark, batch_id - 1) if batch_id else None)
        if before is None and (batch_id or self.committed_batches(spark)):
            raise RuntimeError(f"batch {batch_id} does not follow the last committed batch")
        if before is not None and before.stream_id != stream_id:
            raise RuntimeError(f"the history belongs to stream {before.stream_id}")
        if commit:
            return None
        return before or Row(stream_id=stream_id, base_version=-1, base_rows=0, delta_rows=0)

    def _touched(self, spark: SparkSession, latest: DataFrame, base: int, upto: int) -> DataFrame:
        """Active versions of the keys in a batch.

        Only the buckets of these keys are opened. The span of the keys goes into the scan, too:
        where new rows concern recent encounters, it spares most of a bucket, sorted by key.
        """
        keys = list(self.contract.key)
        first = keys[0]
        modulus, _ = self._places(spark, base)
        known = latest.agg(
            F.count("*").alias("n"), F.min(first), F.max(first),
            F.collect_set(self._bucket(modulus)).alias("buckets")).first()
        opened = self._delta(spark, base, upto).where("kind = 'open'").drop("kind")
        candidates = self._base(spark, base, set(known.buckets)).unionByName(opened)
        if known.n == 0:
            return candidates.where("false")
        candidates = candidates.where(F.col(first).between(known[1], known[2]))
        # A written table: Spark knows its size and sends it to all tasks if it is small.
        found = candidates.join(latest.select(*keys), keys, "left_semi")
        return dedup_latest(found, keys, "start_time")

    def _unchanged(self) -> Column:
        # Where a row came from, and under which name, is no change of state.
        values = [c for c in self.contract.payload if c != "lineage_file_uuid"]
        same = [F.col(c).eqNullSafe(F.col(f"target.{c}")) for c in values]
        return reduce(Column.__and__, same)

    def _changes(self, rows: DataFrame) -> DataFrame:
        """Each joined row as the versions it closes and opens, or as a late row, in one pass.

        A row with the time and the values of the active version is a replay and changes
        nothing; another one that is not newer is late.
        """

        def tagged(kind: str, version: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), version.alias("version"))

        opened = tagged("open", opened_version(self.contract))
        closed = tagged("closed", closed_version())
        late = tagged("late", opened_version(self.contract))
        nothing = F.filter(F.array(opened), lambda _: F.lit(False))
        newer = F.col("ingested_at") > F.col("target.start_time")
        same_time = F.col("ingested_at") == F.col("target.start_time")
        skipped = newer | same_time if self.skip_unchanged else same_time
        changes = (
            F.when(F.col("action") == "INSERT", F.array(opened))
            .when(skipped & self._unchanged(), nothing)
            .when(newer, F.array(closed, opened))
            .otherwise(F.array(late))
        )
        exploded = rows.select(F.explode(changes).alias("change"))
        return exploded.select("change.version.*", "change.kind")

    def _every_arrival(self, rows: DataFrame) -> DataFrame:
        """The versions of all joined rows: chained among themselves, the first behind the
        active version of its key. Rows that are not newer than that are replays or late.
        """
        newer = F.col("ingested_at") > F.col("target.start_time")
        fresh = rows.where(F.col("target").isNull() | newer)
        names = self.contract.staging_schema().names
        chained = chain_distinct(fresh.select(*names), contract=self.contract)
        chained = chained.withColumn("kind", F.when(F.col("is_current"), "open").otherwise("closed"))
        ends = fresh.where("target IS NOT NULL").groupBy(*self.contract.key).agg(
            F.min("ingested_at").alias("ingested_at"), F.first("target").alias("target")
        )
        closed = ends.select(closed_version().alias("version"), F.lit("closed").alias("kind"))
        older = self._changes(rows.where(F.col("target").isNotNull() & ~newer))
        return chained.unionByName(closed.select("version.*", "kind")).unionByName(older)

    def fold(self, spark: SparkSession, batch: DataFrame, batch_id: int, stream_id: str) -> None:
        """Fold one batch of staging rows. A committed batch is left alone; one that a lost
        driver left unfinished is written again from its start.
        """
        before = self._check(spark, batch_id, stream_id)
        if before is None:
            return
        base = before.base_version
        keys = list(self.contract.key)
        schema = self.contract.staging_schema()
        rows = batch.select(*schema.names)
        usable = self._usable()
        if STAGED_IN in batch.columns:
            files = batch.select(STAGED_IN).distinct().coalesce(1)
            files.write.mode("overwrite").parquet(f"{self.root}/cuts/batch_id={batch_id}")
        rows.where(~usable).write.mode("overwrite").parquet(
            f"{self.root}/unusable/batch_id={batch_id}"
        )
        latest_path = f"{self.root}/work/batch_id={batch_id}"
        joined_path = f"{self.root}/work/joined/batch_id={batch_id}"
        one_per = [*keys, "ingested_at"] if self.keep_all else keys
        write_work_table(dedup_latest(rows.where(usable), one_per), latest_path)
        # Read in the session of the caller: a micro-batch has a session of its own,
        # in which Spark does not adapt plans to the sizes it meets.
        latest = spark.read.schema(schema).parquet(latest_path)
        joined = join_active(
            latest, self._touched(spark, latest, base, batch_id - 1), self.contract
        )
        if self.keep_all:
            # Several steps read it.
            joined = write_work_table(joined, joined_path)
        changes = self._every_arrival(joined) if self.keep_all else self._changes(joined)
        changes.write.mode("overwrite").partitionBy("kind").parquet(
            f"{self.root}/delta/batch_id={batch_id}"
        )
        opened = self._delta(spark, batch_id - 1, batch_id).where("kind = 'open'").count()
        state = {
            "stream_id": stream_id,
            "base_version": base,
            "base_rows": before.base_rows,
            "delta_rows": before.delta_rows + opened,
        }
        if self._is_due(batch_id - base, state["base_rows"], state["delta_rows"]):
            self._compact(spark, base, batch_id)
            held = self._base(spark, batch_id).count()
            state |= {"base_version": batch_id, "base_rows": held, "delta_rows": 0}
        commit = spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in state.items()])
        commit.write.mode("overwrite").json(self._commit_path(batch_id))
        complete(spark, self._commit_path(batch_id))
        for path in (latest_path, joined_path):
            delete(spark, path)

    def _is_due(self, deltas: int, base_rows: int, delta_rows: int) -> bool:
        grown = delta_rows > 0 and delta_rows >= base_rows * self.compact_share
        return (deltas >= self.compact_every and grown) or deltas >= self.most_deltas

    def _compact(self, spark: SparkSession, base: int, upto: int) -> None:
        modulus, places = self._places(spark, base)
        opened = self._delta(spark, base, upto).where("kind = 'open'")
        touched = None
        if modulus == self.buckets:
            touched = {r.bucket for r in opened.select(self._bucket(modulus).alias("bucket")).distinct().collect()}
        active = self._active(spark, base, upto, touched).withColumn("bucket", self._bucket(self.buckets))
        layout = history_layout(active, self.contract, "bucket")
        layout.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/base/version={upto}")
        written = [n for n in child_names(spark, f"{self.root}/base/version={upto}") if n.startswith("bucket=")]
        now = (places if touched is not None else {}) | {int(n.split("=")[1]): upto for n in written}
        # A base without rows still has a row here, which names no bucket.
        rows = [(b, v, self.buckets) for b, v in sorted(now.items())] or [(None, upto, self.buckets)]
        spark.createDataFrame(rows, _BUCKETS).coalesce(1).write.mode("overwrite").json(
            f"{self.root}/buckets/version={upto}")
        ended = self._delta(spark, base, upto).where("kind <> 'open'")
        history_layout(ended, self.contract, "kind").write.mode("overwrite").partitionBy(
            "kind"
        ).parquet(f"{self.root}/settled/version={upto}")

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete what the last ``keep`` bases and the batches behind them do not need."""
        version, _ = self._state(spark)
        stored = [int(n.split("=")[1]) for n in child_names(spark, f"{self.root}/buckets")]
        kept = sorted(v for v in stored if v <= version)[-keep:]
        if not kept:
            return
        needed = {(v, b) for base in kept for b, v in self._places(spark, base)[1].items()}
        for child in child_names(spark, f"{self.root}/base"):
            of = int(child.split("=")[1])
            buckets = [b for b in child_names(spark, f"{self.root}/base/{child}") if b.startswith("bucket=")]
            unneeded = [b for b in buckets if of < kept[0] and (of, int(b.split("=")[1])) not in needed]
            for bucket in unneeded:
                delete(spark, f"{self.root}/base/{child}/{bucket}")
            if of < kept[0] and len(unneeded) == len(buckets):
                delete(spark, f"{self.root}/base/{child}")
        for folder in ("buckets", "commits", "delta"):
            # The oldest kept base stays, and so does its commit, but not the delta in it.
            oldest = kept[0] + 1 if folder == "delta" else kept[0]
            for child in child_names(spark, f"{self.root}/{folder}"):
                if int(child.split("=")[1]) < oldest:
                    delete(spark, f"{self.root}/{folder}/{child}")


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query when its checkpoint was made."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def fold_new_rows(
    spark: SparkSession,
    staging: str,
    table: HistoryTable,
    checkpoint: str,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Fold all staging rows not folded yet, then stop; without new rows nothing runs.

    Any scheduler may call this at any interval.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        table.fold(spark, batch, batch_id, stream_id_of(spark, checkpoint))

    return (
        staging_changes(spark, staging, table.contract, max_files)
        .writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
