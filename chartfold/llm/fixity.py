"""Merkle fixity audit of WARC replicas.

A replica is a set of archives; an archive holds records at ascending offsets. A record's
hash is the SHA-256 of its bytes. Level 0 of a tree has a node per range of SPAN bytes, whose
hash covers offset, length and hash of the records that begin there, in order; a node of each
level above covers FANOUT nodes below. Nodes are numbered by offset, not by count, so a lost
record changes only its own branch. The audit compares roots, then, level by level, only the
children of nodes that differ, and at last only the records of differing ranges.

Skew: hashes are made where the records are read, and only they move. Records are dealt out
by ranges of archive, id, digest and row, each of about RANGE_ROWS whatever one archive or one
id holds; offsets are sums within a range, added to the sums of the archive's ranges before.

Defined cases: a null page has an empty payload; a null page id is in archive -1; rows of
equal id are records behind each other; records that only one replica has are `missing` or
`extra`; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.llm.text import table
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

SPAN = 1 << 18
FANOUT = 16
ARCHIVE_PAGES = 1000
RANGE_ROWS = 50_000


def warc_record(url: str | Column, body: str | Column) -> Column:
    """The bytes of a WARC resource record, as text."""
    body = F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def leaves(records: DataFrame) -> DataFrame:
    """(archive, offset, length, digest) of records (archive, offset, payload)."""
    return records.select("archive", "offset", F.octet_length("payload").cast("long").alias("length"),
                          F.sha2(F.col("payload").cast("binary"), 256).alias("digest"))


def levels(hashed: DataFrame, count: int, span: int = SPAN, fanout: int = FANOUT) -> list[DataFrame]:
    """Node tables (archive, node, digest), from ranges of records up to one root an archive."""
    item = F.concat_ws(":", "offset", "length", "digest")
    node = F.floor(F.col("offset") / span).alias("node")
    rows = hashed.groupBy("archive", node).agg(_joined("offset", item))
    made = [write_work_table(rows, fresh_folder(hashed.sparkSession, "merkle"))]
    for _ in range(count):
        below = made[-1]
        item = F.concat_ws(":", "node", "digest")
        rows = below.groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(
            _joined("node", item)).withColumnRenamed("up", "node")
        made.append(write_work_table(rows, fresh_folder(hashed.sparkSession, "merkle")))
    return made


def _joined(order: str, item: Column) -> Column:
    """Hash of the items of a group in order; a group is bounded by the span or the fanout."""
    listed = F.sort_array(F.collect_list(F.struct(order, item.alias("item"))))
    return F.sha2(F.array_join(listed["item"], "\n").cast("binary"), 256).alias("digest")


def audit(left: DataFrame, right: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """Records (archive, offset) that differ, with status corrupt, missing (in right) or extra."""
    spark = left.sparkSession
    sides = [write_work_table(side, fresh_folder(spark, "leaves")) for side in (left, right)]
    last = sides[0].unionByName(sides[1]).agg(F.max("offset")).first()[0] or 0
    count, ranges = 0, last // span + 1
    while ranges > 1:
        ranges, count = -(-ranges // fanout), count + 1
    trees = [levels(side, count, span, fanout) for side in sides]
    differing = _differing(*(tree[-1] for tree in trees))
    for level in range(count - 1, -1, -1):
        parents = differing.withColumnRenamed("node", "up")
        below = [tree[level].withColumn("up", F.floor(F.col("node") / fanout)).join(
            parents, ["archive", "up"], "left_semi").drop("up") for tree in trees]
        differing = write_work_table(_differing(*below), fresh_folder(spark, "merkle"))
    suspect = [side.withColumn("node", F.floor(F.col("offset") / span)).join(
        differing, ["archive", "node"], "left_semi").drop("node") for side in sides]
    a, b = (side.select("archive", "offset", F.struct("length", "digest").alias(name))
            for side, name in zip(suspect, "ab"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(
        F.col("a") != F.col("b"), "corrupt")
    return a.join(b, ["archive", "offset"], "full").select("archive", "offset", status.alias("status")).where(
        "status IS NOT NULL")


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    a, b = a.withColumnRenamed("digest", "a"), b.withColumnRenamed("digest", "b")
    return a.join(b, ["archive", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "node")


def page_archives(pages: DataFrame, archive_pages: int = ARCHIVE_PAGES) -> DataFrame:
    """Pages packed into archives by id: (page_id, archive, offset, payload length and digests)."""
    record = warc_record("url", "html")
    # The second replica: some records hold one other byte, a few are gone.
    spoilt = F.overlay(record, F.lit("#"), F.lit(1))
    bad, lost = F.col("page_id") % 97 == 13, F.col("page_id") % 499 == 7
    hashed = pages.select(
        "page_id", F.coalesce(F.floor(F.col("page_id") / archive_pages), F.lit(-1)).alias("archive"),
        F.octet_length(record).cast("long").alias("length"), F.sha2(record.cast("binary"), 256).alias("digest"),
        F.when(bad, F.sha2(spoilt.cast("binary"), 256)).alias("spoilt"), F.coalesce(lost, F.lit(False)).alias("lost"))
    spark = pages.sparkSession
    hashed = write_work_table(hashed.withColumn("row", F.monotonically_increasing_id()), fresh_folder(spark, "hashed"))
    key = ["archive", "page_id", "digest", "row"]
    ranges = hashed.repartitionByRange(max(1, -(-hashed.count() // RANGE_ROWS)), *key)
    ranges = write_work_table(ranges.withColumn("range", F.spark_partition_id()), fresh_folder(spark, "ranges"))
    before = Window.unboundedPreceding, -1
    inner = Window.partitionBy("archive", "range").orderBy("page_id", "digest", "row").rowsBetween(*before)
    outer = Window.partitionBy("archive").orderBy("range").rowsBetween(*before)
    sums = ranges.groupBy("archive", "range").agg(F.sum("length").alias("size"))
    sums = sums.select("archive", "range", F.coalesce(F.sum("size").over(outer), F.lit(0)).alias("base"))
    inside = ranges.withColumn("inside", F.coalesce(F.sum("length").over(inner), F.lit(0)))
    return inside.join(sums, ["archive", "range"]).withColumn("offset", F.col("base") + F.col("inside")).drop(
        "base", "inside", "range", "row")


def op4_merkle_audit(spark, sf_dir: str) -> DataFrame:
    """Every record of the first replica, with what the audit finds at its place in the second."""
    held = write_work_table(page_archives(table(spark, sf_dir, "pages")), fresh_folder(spark, "replica"))
    left = held.select("archive", "offset", "length", "digest")
    right = held.where("NOT lost").select("archive", "offset", "length", F.coalesce("spoilt", "digest").alias("digest"))
    found = audit(left, right)
    return held.join(found, ["archive", "offset"], "left").select(
        "page_id", "archive", "offset", "length", "digest", F.coalesce("status", F.lit("intact")).alias("status"))


ORACLE = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
      || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
      || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages),
h AS (
  SELECT page_id, CAST(coalesce(floor(page_id / 1000.0), -1) AS BIGINT) AS archive,
    CAST(strlen(payload) AS BIGINT) AS length, sha256(payload) AS digest FROM r)
SELECT page_id, archive, length, digest,
  CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CASE WHEN page_id % 499 = 7 THEN 'missing' WHEN page_id % 97 = 13 THEN 'corrupt' ELSE 'intact' END AS status
FROM h
"""
