"""Hard-negative mining by length buckets and coordinate pruning.

Rows are dealt into buckets by descending length of their vectors. A bucket holds its vectors
normalised and, for each coordinate, their order by value. An anchor with a score to reach gets
an angle from it and from the bucket's largest length: a vector within that angle of the
anchor has each coordinate within a range around the anchor's own. The ranges of the anchor's
largest (focus) coordinates are looked up in the sorted lists; their intersection holds all
rows that can reach the score, which are then scored exactly, in integers. An anchor that no
row of a bucket can satisfy skips it; where the ranges hold most of a bucket, the lists are
passed over and all its rows scored.

Two searches use this. Positives: the best rows of the anchor's own label. Negatives: the best
rows of other labels whose score lies in [80 %, 100 %] of a positive's. Each runs first over
the bucket of longest vectors; what is found there raises the score to reach in all others.

Work: every pair of (bucket, block of anchors) is one group, of about BUCKET_ROWS rows and
BLOCK_ANCHORS anchors, fewer if vectors are wide; a group returns at most the wanted number of rows per anchor (and
positive). Labels play no part in how rows are dealt, so a label with a third of all rows, or
many equal vectors, spread alike. Anchors against all rows is what the query asks; unless
scores are high, the ranges rule out little and the exact scores are the cost.

Defined cases: rows with a null label, a null vector, or any null or non-finite component take
no part; a row without vec_id is no anchor, keeps its label and ties last; rows with equal
vec_id are rows (and anchors) of their own; missing components of a shorter vector are zero;
components beyond 2^24 after scaling count as 2^24, so that sums stay whole numbers of 64 bits;
an anchor without positives gives no rows, and so does an empty table; vectors of any length
are stored as 32-bit numbers; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartfold.llm.text import table
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

SCALE = 256
TOP = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
LIMIT = 1 << 24
# A group holds so many components of rows and of anchors, and never more rows than this.
BUCKET_CELLS, BUCKET_ROWS = 1 << 20, 16_384
BLOCK_ANCHORS = 8_192
FOCUS = 4
# Lists are passed over where the ranges leave more than this share of a bucket.
WORTH = 0.3
TILE = 128

POSITIVE = "anchor long, anchor_id long, found_id long, found long, score long"
NEGATIVE = "anchor long, anchor_id long, bound long, found_id long, score long"


def prepared(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, vector of ints, length) of the rows that take part, labels shifted."""
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.greatest(F.lit(-LIMIT), F.least(
        F.lit(LIMIT), F.floor(F.greatest(F.lit(-2.0 * LIMIT), F.least(F.lit(2.0 * LIMIT), x.cast("double") * scale))))).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = embeddings.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), whole.alias("vector"))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("length", F.sqrt(length))


class Bucket:
    """Vectors of a bucket, ordered by id, with their sorted coordinate lists."""

    def __init__(self, rows: pa.Table, width: int):
        ids = rows["vec_id"].combine_chunks()
        order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        self.rows = rows["row"].to_numpy()[order]
        self.ids = rows["vec_id"].take(pa.array(order)).to_pylist()
        self.labels = rows["label"].to_numpy()[order]
        self.vectors = matrix(rows["vector"], width)[order]
        self.lengths = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(self.lengths.max()) if len(order) else 0.0
        self.unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        self.lists = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.lists, axis=0)

    def candidates(self, vector: np.ndarray, least: float) -> np.ndarray | None:
        """Places of the rows whose product with the vector can reach `least`; None: all of them."""
        size = float(np.sqrt((vector.astype(np.float64) ** 2).sum()))
        if least <= 0:
            return None
        cosine = least / max(size * self.longest, 1e-300)
        if cosine > 1 + 1e-9:
            return np.zeros(0, np.int64)
        unit = vector / size
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        angle, slack = np.arccos(min(cosine, 1.0)), 1e-7
        own = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, own + angle)) - slack
        high = np.cos(np.maximum(0, own - angle)) + slack
        spans = [(np.searchsorted(self.values[:, f], lo, "left"), np.searchsorted(self.values[:, f], hi, "right"))
                 for f, lo, hi in zip(focus, low, high, strict=True)]
        best = sorted(range(len(focus)), key=lambda i: spans[i][1] - spans[i][0])
        if not best or spans[best[0]][1] - spans[best[0]][0] > WORTH * len(self.ids):
            return None
        found = self.lists[slice(*spans[best[0]]), focus[best[0]]]
        for i in best[1:]:
            seen = self.unit[found, focus[i]]
            found = found[(seen >= low[i]) & (seen <= high[i])]
        return np.sort(found)


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of ints as rows of one array, filled up with zeros."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; by floating point where that is exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[-1])
    if most < 2**53:
        return np.rint(left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def scored(bucket: Bucket, vectors: np.ndarray, least: np.ndarray):
    """For each anchor (place of the anchor, places in the bucket, scores) of all rows that can
    reach its least score."""
    every = []
    for i, vector in enumerate(vectors):
        places = bucket.candidates(vector, least[i])
        if places is None:
            every.append(i)
        elif len(places):
            yield i, places, products(vector[None, :], bucket.vectors[places])[0]
    whole = np.arange(len(bucket.ids))
    for at in range(0, len(every), TILE):
        some = every[at:at + TILE]
        for i, scores in zip(some, products(vectors[some], bucket.vectors), strict=True):
            yield i, whole, scores


def _best(places: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """The first `top` by score, ties by place (ids ascend with places)."""
    if len(scores) > top:
        keep = scores >= np.partition(scores, len(scores) - top)[len(scores) - top]
        places, scores = places[keep], scores[keep]
    return places[np.lexsort((places, -scores))[:top]]


def _nulls(values: list) -> pa.Array:
    return pa.array(values, pa.int64())


def positives_of(width: int, top: int):
    """Rows of the anchors' own labels, for one bucket and one block."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in POSITIVE.split(", ")])

    def mine(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        bucket, out = Bucket(rows, width), [[], [], [], [], []]
        vectors, labels = matrix(anchors["vector"], width), anchors["label"].to_numpy()
        keys, ids = anchors["row"].to_numpy(), anchors["vec_id"].to_pylist()
        for i, places, scores in scored(bucket, vectors, anchors["least"].to_numpy()):
            fit = (bucket.labels[places] == labels[i]) & (bucket.rows[places] != keys[i])
            places, scores = places[fit], scores[fit]
            score_at = dict(zip(places.tolist(), scores.tolist(), strict=True)) if len(places) <= top else None
            best = _best(places, scores, top)
            if score_at is None:
                where = np.searchsorted(places, best)
                values = scores[where].tolist()
            else:
                values = [score_at[p] for p in best.tolist()]
            for p, value in zip(best.tolist(), values, strict=True):
                for column, x in zip(out, (int(keys[i]), ids[i], bucket.ids[p], int(bucket.rows[p]), value), strict=True):
                    column.append(x)
        return pa.table([_nulls(c) for c in out], schema=schema)

    return mine


def negatives_of(width: int, top: int):
    """Rows of other labels below each distinct positive score, for one bucket and one block."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in NEGATIVE.split(", ")])

    def mine(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        bucket, out = Bucket(rows, width), [[], [], [], [], []]
        vectors, labels = matrix(anchors["vector"], width), anchors["label"].to_numpy()
        keys, ids = anchors["row"].to_numpy(), anchors["vec_id"].to_pylist()
        bounds, least = anchors["bounds"].to_pylist(), anchors["least"].to_pylist()
        for i, places, scores in scored(bucket, vectors, np.array([min(x) for x in least], np.float64)):
            fit = (bucket.labels[places] != labels[i]) & (scores >= min(least[i])) & (scores <= max(bounds[i]))
            places, scores = places[fit], scores[fit]
            order = np.lexsort((places, -scores))
            places, scores = places[order], scores[order]
            for bound, floor in zip(bounds[i], least[i], strict=True):
                at = int(np.searchsorted(-scores, -bound, "left"))
                for p, value in zip(places[at:at + top].tolist(), scores[at:at + top].tolist(), strict=True):
                    if value < floor or HIGH * value < LOW * bound:
                        break
                    for column, x in zip(out, (int(keys[i]), ids[i], bound, bucket.ids[p], value), strict=True):
                        column.append(x)
        return pa.table([_nulls(c) for c in out], schema=schema)

    return mine


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, buckets: tuple[int, int], mine, schema: str) -> DataFrame:
    """All groups of (bucket, block) for a range of buckets."""
    low, high = buckets
    part = rows.where(F.col("bucket").between(low, high)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = anchors.withColumn("bucket", F.explode(F.sequence(F.lit(low), F.lit(high))))
    keys = ["bucket", "block"]
    return part.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(mine, schema)


def _first(found: DataFrame, by: list[str], top: int) -> DataFrame:
    """The best rows per group over all buckets, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("found_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def hard_negatives(embeddings: DataFrame, anchor_step: int = 100, top: int = TOP,
                   bucket_rows: int = BUCKET_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """(anchor, anchor_id, positive_id, positive_rank, positive_score, rank, negative_id, negative_score)."""
    spark = embeddings.sparkSession
    rows = write_work_table(prepared(embeddings), fresh_folder(spark, "vectors"))
    count, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = width or 0
    bucket_rows, block_anchors = (max(1, min(n, BUCKET_CELLS // max(1, width))) for n in (bucket_rows, block_anchors))
    rows = rows.repartitionByRange(max(1, -(-count // bucket_rows)), F.desc("length"), "vec_id", "row")
    rows = write_work_table(rows.withColumn("bucket", F.spark_partition_id()), fresh_folder(spark, "buckets"))
    anchors = rows.where(F.col("vec_id") % anchor_step == 0).select("row", "vec_id", "label", "vector")
    anchors = anchors.repartitionByRange(max(1, -(-anchors.count() // block_anchors)), "vec_id", "row")
    anchors = write_work_table(anchors.withColumn("block", F.spark_partition_id()), fresh_folder(spark, "anchors"))
    blocks = (anchors.agg(F.max("block")).first()[0] or 0) + 1
    first, last = rows.agg(F.min("bucket"), F.max("bucket")).first()
    first, last = first or 0, last or 0

    def rounds(mine, schema: str, asked: DataFrame, raised) -> DataFrame:
        """The bucket of longest vectors, then all others with what it found."""
        pilot = write_work_table(_search(rows, asked, blocks, (first, first), mine, schema), fresh_folder(spark, "pilot"))
        if last == first:
            return pilot
        return pilot.unionByName(_search(rows, raised(asked, pilot), blocks, (first + 1, last), mine, schema))

    def least_positive(asked: DataFrame, pilot: DataFrame) -> DataFrame:
        full = pilot.groupBy(F.col("anchor").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("fifth"))
        reach = F.when(F.col("n") >= top, F.col("fifth").cast("double")).otherwise(F.col("least"))
        return asked.join(full, "row", "left").withColumn("least", reach).drop("n", "fifth")

    nowhere = F.lit(float("-inf")).alias("least")
    found = rounds(positives_of(width, top), POSITIVE, anchors.select("*", nowhere), least_positive)
    positives = write_work_table(_first(found, ["anchor"], top).select(
        "anchor", "anchor_id", F.col("found_id").alias("positive_id"), F.col("rank").alias("positive_rank"),
        F.col("score").alias("positive_score")), fresh_folder(spark, "positives"))

    bounds = positives.where("positive_score >= 0").groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("bounds"))
    asked = anchors.join(bounds, "row").withColumn("least", F.transform(
        "bounds", lambda b: F.floor(b.cast("double") * (LOW / HIGH) - 1)))

    def least_negative(asked: DataFrame, pilot: DataFrame) -> DataFrame:
        full = pilot.groupBy("anchor", "bound").agg(F.count("*").alias("n"), F.min("score").alias("fifth"))
        full = full.where(F.col("n") >= top).groupBy(F.col("anchor").alias("row")).agg(
            F.map_from_entries(F.collect_list(F.struct("bound", "fifth"))).alias("raised"))
        reach = F.zip_with("bounds", "least", lambda b, x: F.coalesce(F.element_at("raised", b), x))
        return asked.join(full, "row", "left").withColumn("least", F.when(
            F.col("raised").isNull(), F.col("least")).otherwise(reach)).drop("raised")

    lower = rounds(negatives_of(width, top), NEGATIVE, asked, least_negative)
    negatives = _first(lower, ["anchor", "bound"], top).select(
        F.col("anchor").alias("of"), "bound", "rank", F.col("found_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    same = (F.col("anchor") == F.col("of")) & (F.col("positive_score") == F.col("bound"))
    return positives.join(negatives, same).drop("of", "bound")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """The hard negatives of all anchors."""
    found = hard_negatives(table(spark, sf_dir, "embeddings"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH e AS (
  SELECT row_number() OVER () AS row, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS row, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.row <> b.row),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, row) <= 5)
SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.id, n.row) AS INTEGER) AS rank
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.id, n.row) <= 5
"""
