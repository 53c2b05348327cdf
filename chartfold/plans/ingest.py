"""One ingest batch: landing files to silver folders, verdicts and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.contracts import Contract
from chartfold.operators.cleaning import clean_rows
from chartfold.operators.quality import HEADER_CONTRACT, MALFORMED, MISSING, verdict
from chartfold.plans.ledger import STATE, Ledger
from chartfold.session import hide_secrets
from chartfold.sinks.quarantine import quarantine_files
from chartfold.sinks.silver import write_silver_csv, write_silver_parquet
from chartfold.sources.landing import Landing, list_files, read_landing
from chartfold.storage import claim, complete, delete, is_complete, qualified, write_once, write_work_table

# Up to this many notified objects are looked up by name; beyond it, the folder is listed.
# Both give the same table of files, whatever the keys look like.
NAMED_OBJECTS = 1_000

OUTCOMES = (
    "object_key string, object_version string, status string, error string, rows_seen bigint,"
    " rows_written bigint, rows_malformed bigint, target string, redelivered boolean"
)


@dataclass(frozen=True)
class Lake:
    """Folders of one data lake, below one root that all executors reach.

    Its ledger of ingested objects is merged every ``merge_every`` batches at most.
    """

    root: str
    merge_every: int = 64

    def silver(self, kind: str) -> str:
        return f"{self.root}/silver/{kind}"

    def work(self, batch_id: int) -> str:
        return f"{self.root}/work/ingest/batch_id={batch_id}"

    def outcomes(self, batch_id: int) -> str:
        return f"{self.root}/outcomes/batch_id={batch_id}"

    def identity(self, batch_id: int) -> str:
        return f"{self.root}/batches/batch_id={batch_id}"

    @property
    def ledger(self) -> Ledger:
        return Ledger(f"{self.root}/ledger", merge_every=self.merge_every)

    @property
    def open_batch(self) -> str:
        return f"{self.root}/batches/_open"

    def quarantine(self, batch_id: int) -> str:
        return f"{self.root}/quarantine/batch_id={batch_id}"


def _check_identity(
    spark: SparkSession, landing: Landing, lake: Lake, batch_id: int, keys: DataFrame | None
) -> None:
    """A batch id belongs to one landing folder and one set of objects for good."""
    objects = "all"
    if keys is not None:
        digest = keys.agg(F.count("*"), F.sum(F.xxhash64("object_key").cast("decimal(38,0)"))).first()
        objects = f"{digest[0]}:{digest[1]}"
    now = (qualified(spark, landing.root), objects)
    path = lake.identity(batch_id)
    if is_complete(spark, path):
        before = spark.read.schema("landing string, objects string").json(path).first()
        if tuple(before) != now:
            raise RuntimeError(f"batch {batch_id} belongs to {before.landing} with other objects or files")
    else:
        marker = spark.range(0, 1, 1, 1).select(F.lit(now[0]).alias("landing"), F.lit(now[1]).alias("objects"))
        marker.write.mode("overwrite").json(path)
        complete(spark, path)


def _claim(spark: SparkSession, lake: Lake, batch_id: int) -> None:
    """Keeps a lake for one batch until its outcomes are written, so that no other batch takes
    objects that it has begun to ingest. A claim that its batch did not give back does not count."""
    owner = claim(spark, lake.open_batch, str(batch_id))
    if owner != str(batch_id) and (not owner or is_complete(spark, lake.outcomes(int(owner)))):
        delete(spark, lake.open_batch)
        owner = claim(spark, lake.open_batch, str(batch_id))
    if owner != str(batch_id):
        raise RuntimeError(f"batch {owner} is not finished: it has to be repeated before batch {batch_id}")


def _listing(spark: SparkSession, landing: Landing, keys: DataFrame | None) -> DataFrame:
    """Files of the batch; of notified objects only, if there are any.

    A file is taken if its own key was notified, however it was found: a name may also lead to a
    folder, or to another object's file by a detour.
    """
    if keys is None:
        return landing.files(spark)
    by_name = keys.count() <= NAMED_OBJECTS
    files = landing.files(spark, [row.object_key for row in keys.collect()] if by_name else None)
    return files.join(keys, "object_key", "left_semi")


def _with_presence(rows: DataFrame, contract: Contract) -> DataFrame:
    """Bit mask of the contract columns a row has, for files without a header."""
    bits = [
        F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(contract.columns)
    ]
    return rows.withColumn("present", reduce(lambda a, b: a.bitwiseOR(b), bits))


def object_outcomes(
    files: DataFrame, rows: DataFrame, contract: Contract, batch_id: int
) -> DataFrame:
    """One verdict per object from its files and from the counts of its rows.

    ``target`` names the silver folder with its rows, or both if its parts took both lanes.
    """
    counts = rows.groupBy("object_key").agg(
        F.count("*").alias("rows_seen"),
        F.count_if("is_valid").alias("rows_written"),
        F.count_if("is_malformed").alias("rows_malformed"),
        F.bit_or("present").alias("present"),
    )
    objects = files.groupBy("object_key", "object_version").agg(
        F.min("reason").alias("reason"),
        F.max("format").alias("format"),
        F.bool_or(F.col("lane") == "small").alias("in_csv"),
        F.bool_or(F.col("lane") == "bulk").alias("in_parquet"),
    )
    targets = [
        F.when(F.col(f"in_{kind}"), f"silver/{kind}/batch_id={batch_id}")
        for kind in ("csv", "parquet")
    ]
    every_column = (1 << len(contract.columns)) - 1
    incomplete = (F.col("format") == "xml") & (F.coalesce("present", F.lit(0)) != every_column)
    # One broken record fails its object: what follows it may be lost with it.
    broken = F.when(F.col("rows_malformed") > 0, MALFORMED).when(incomplete, HEADER_CONTRACT)
    judged = verdict(objects, counts, F.concat_ws(",", *targets), broken=broken)
    columns = [c.split()[0] for c in OUTCOMES.split(", ")]
    return judged.withColumn("redelivered", F.lit(False)).select(*columns)


def ingest_batch(
    spark: SparkSession,
    landing: Landing,
    lake: Lake,
    batch_id: int,
    contract: Contract,
    key: str,
    notified: DataFrame | None = None,
    on_step: Callable[[str], None] = lambda step: None,
) -> DataFrame:
    """Ingest the files of a landing folder and return one outcome per object.

    ``notified``, with a column ``object_key``, limits the batch to the named objects; one
    that is not there, or holds no bytes, fails. An object that another batch ingested in the
    same state is not ingested again: if it was notified, its outcome is the earlier one,
    marked ``redelivered``. A batch id belongs to its folder and its objects; another use of
    it is an error, and so is a batch while another one is unfinished.
    The raw files are parsed once, into a work table; counts and both silver folders come
    from there. The size of a file decides which silver folder takes its rows: all rows are those of
    both. A repeated call picks up where a lost one stopped, and changes nothing
    once the outcomes are written. Silver and outcomes are written once: what a stream has
    read of them while a call was lost stays as it was. ``on_step`` hears of each step done.
    """
    hide_secrets(spark)
    keys = None if notified is None else notified.select("object_key").distinct()
    _check_identity(spark, landing, lake, batch_id, keys)
    on_step("identity")
    done, work = lake.outcomes(batch_id), lake.work(batch_id)
    if is_complete(spark, done):
        delete(spark, work)
        return spark.read.parquet(done)
    _claim(spark, lake, batch_id)
    on_step("claim")

    def kept(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table a former attempt of this batch finished, or a new one."""
        path = f"{work}/{name}"
        made = spark.read.parquet(path) if is_complete(spark, path) else write_work_table(make(), path)
        on_step(name)
        return made

    listing = kept("listing", lambda: _listing(spark, landing, keys))
    known = kept("known", lambda: lake.ledger.lookup(spark, listing, batch_id))
    fresh = listing.join(known, STATE, "left_anti")
    files = kept("files", lambda: list_files(spark, landing, contract, fresh, f"{work}/records"))

    def cleaned() -> DataFrame:
        landed = _with_presence(read_landing(spark, landing, files, contract), contract)
        return clean_rows(landed, contract, key, ("object_key", "lane", "is_malformed", "present"))

    rows = kept("rows", cleaned)

    def judged() -> DataFrame:
        found = object_outcomes(files, rows, contract, batch_id)
        if keys is None:
            return found
        again = known.select(
            *STATE, F.lit("success").alias("status"), "rows_seen", "rows_written",
            F.lit(0).cast("bigint").alias("rows_malformed"), "target", F.lit(True).alias("redelivered"),
        )
        gone = keys.join(listing.select("object_key").distinct(), "object_key", "left_anti").select(
            "object_key", F.lit("failed").alias("status"), F.lit(MISSING).alias("error"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("rows_seen", "rows_written", "rows_malformed")],
            F.lit(False).alias("redelivered"),
        )
        return found.unionByName(again, True).unionByName(gone, True)

    outcomes = kept("outcomes", judged)
    failed = outcomes.where("status = 'failed'").select("object_key")
    accepted = rows.where("is_valid").join(failed, "object_key", "left_anti")
    write_silver_csv(accepted.where("lane = 'small'"), lake.silver("csv"), batch_id, contract, on_step)
    write_silver_parquet(accepted.where("lane = 'bulk'"), lake.silver("parquet"), batch_id, contract, on_step)
    rejected = files.join(failed, "object_key", "left_semi")
    quarantine_files(spark, landing, rejected, lake.quarantine(batch_id))
    on_step("quarantine")

    lake.ledger.record(outcomes, batch_id)
    write_once(spark, done, lambda path: outcomes.write.mode("overwrite").parquet(path), on_step)
    lake.ledger.merge(spark)
    delete(spark, work)
    delete(spark, lake.open_batch)
    return spark.read.parquet(done)
