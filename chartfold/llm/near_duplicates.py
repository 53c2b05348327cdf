"""MinHash near-dedup with sequential Bayesian verification.

A text's set are its distinct word shingles. Texts with equal sets are one class from the
start, whose representative has its least id. Signatures of 128 hashes are banded; texts that
share a band are candidates. A candidate pair is compared batch after batch of its signature:
after n hashes of which m agree, the similarity has a Beta(m + 1, n - m + 1) posterior, and
the pair is dropped once the probability of reaching the threshold falls below MISS. What
survives is verified on the full sets. Bands are as many as the threshold needs: a pair at it
shares none with a probability of 2.6e-5 at 0.85 (18 bands) and 4.9e-5 at 0.8 (25, all that
128 hashes give); the tests drop it with 1e-5 at most per batch.

No bucket is expanded into pairs: links only matter until documents are connected. First
every member of a bucket is compared with its least one. Then, where a bucket still holds
several components, members of different components meet in tiles, are tested on signatures
and verified within the task, and a tile gives only the links that join components. Members
of a bucket's largest component meet those of others only, so that few strays among
very many near copies cost one more sending of each copy.

Defined cases: null and empty texts have an empty set, are linked with nothing and kept; a
text of fewer words than a shingle has its whole sequence as its one shingle; a row without
id has no component and is kept; rows of equal id are one vertex; an empty table gives an
empty result; other columns pass through `one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.components import components
from chartfold.llm.grams import U, Words, grams, mixed, per_text, slices, texts, window_hash
from chartfold.llm.text import table
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

HASHES, ROWS, BATCH = 128, 5, 16
MISS = 1e-5
UNBANDED = 2.7e-5  # probability aimed at that a pair at the threshold shares no band
TILE = 512
_draw = np.random.default_rng(77)
FACTORS = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
SHIFTS = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64)
SETS = "doc_id long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>"


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, with the n + 1 places of the texts in them."""
    words = Words(data, offsets, lower=True)
    n = words.counts()
    _, of, h = grams(words.hashes, words.first, k)
    few = np.flatnonzero((n > 0) & (n < k))
    whole = window_hash(words.hashes, words.first[few], words.first[few + 1])
    of, h = np.concatenate([of, few]), np.concatenate([h, whole])
    _, at = np.unique(mixed(h + of.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True)
    at = at[np.argsort(of[at], kind="stable")]
    return h[at], np.searchsorted(of[at], np.arange(len(n) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each text's shingles; 0 for empty sets."""
    out = np.zeros((len(first) - 1, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for i in range(HASHES):
            least = np.minimum.reduceat(hashes * FACTORS[i] + SHIFTS[i], first[:-1][full])
            out[full, i] = (least >> U(32)).astype(np.uint32)
    return out


def bands_for(threshold: float) -> int:
    """How many bands of ROWS hashes a pair at the threshold needs, or all that there are."""
    return min(HASHES // ROWS, ceil(log(UNBANDED) / log1p(-threshold ** ROWS))) if threshold < 1 else 1


def sets(docs: DataFrame, k: int, n_bands: int) -> DataFrame:
    """One row per document: size of its set, two sums that name the set, signature and bands."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            for i, j, d, o in slices(data, offsets):
                h, first = shingles(d, o, k)
                n = np.diff(first)
                signed = signatures(h, first)
                cut = signed[:, :n_bands * ROWS].astype(U).reshape(-1, ROWS)
                band = window_hash(mixed(cut.ravel()), np.arange(len(cut)) * ROWS, np.arange(1, len(cut) + 1) * ROWS)
                band = mixed(band.reshape(-1, n_bands) + np.arange(n_bands, dtype=U) * U(0x9E3779B97F4A7C15))
                band = pa.array(band.astype(np.int64).ravel())
                bands = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * n_bands), band)
                sums = [per_text(mixed(h + U(s)).astype(np.int64), first) for s in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(n.astype(np.int64)),
                    *(pa.array(s.astype(np.int64)) for s in sums),
                    pa.array([row.tobytes() for row in signed], pa.binary()), bands],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature", "bands"])

    return docs.select("doc_id", "text").mapInArrow(task, SETS)


def least_matches(threshold: float, miss: float = MISS) -> np.ndarray:
    """For each batch the fewest agreeing hashes with which a pair may still reach the threshold."""
    s = (np.arange(4000) + 0.5) / 4000
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = (lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1) + m * np.log(s) + (n - m) * np.log1p(-s))
            if np.exp(log)[s >= threshold].sum() / 4000 >= miss:
                break
        least.append(m)
    return np.array(least)


def survivors(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature tables that pass all batches, and their agreeing hashes."""
    alive, agree = np.arange(len(left)), np.zeros(len(left), np.int64)
    for step, fewest in enumerate(least):
        cut = slice(step * BATCH, (step + 1) * BATCH)
        agree = agree + (left[alive, cut] == right[alive, cut]).sum(axis=1)
        passed = agree >= fewest
        alive, agree = alive[passed], agree[passed]
    return alive, agree


def signed(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def prune(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the sequential test leaves."""
    least = least_matches(threshold)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive, _ = survivors(signed(batch.column("sig_a")), signed(batch.column("sig_b")), least)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    ends = [classes.select(F.col("doc_id").alias(e), F.col("signature").alias(f"sig_{e}")) for e in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "sig_a", "sig_b").mapInArrow(task, "a long, b long")


def tiled(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """(band, low, high, own, doc_id, component): the tiles in which the members of open buckets meet.

    Tiles are numbered, first those of members outside the bucket's largest component, which
    meet all tiles, then those of its largest, which meet the others only.
    """
    named = buckets.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    counted = named.groupBy("band", "component").agg(F.count("*").alias("n"))
    apart = counted.groupBy("band").agg(
        F.count("*").alias("components"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest"))
    apart = apart.where("components > 1").select(
        "band", F.col("largest.component").alias("largest"),
        F.ceil((F.col("n") - F.col("largest.n")) / TILE).cast("int").alias("few"),
        F.ceil(F.col("largest.n") / TILE).cast("int").alias("many"))
    largest, draw = F.col("component") == F.col("largest"), F.xxhash64("doc_id")
    own = F.when(largest, F.col("few") + F.pmod(draw, F.col("many"))).otherwise(F.pmod(draw, F.col("few")))
    meets = F.when(largest, F.col("few")).otherwise(F.col("few") + F.col("many"))
    members = named.join(apart, "band").withColumns({"own": own.cast("int"), "meets": meets})
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
    return members.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                          "own", "doc_id", "component")


def cross(buckets: DataFrame, classes: DataFrame, known: DataFrame, parts: DataFrame, k: int,
          percent: int) -> DataFrame:
    """Verified links (a, b) between components that still share a bucket.

    Members of a bucket meet in tiles of bounded size, a pair only in the first band that it
    shares. A tile tests pairs of different components on signatures, verifies the survivors
    on full sets, the likeliest first, and gives one link for each two components that it
    joins: pairs are never rows.
    """
    least = least_matches(percent / 100)
    members = tiled(buckets, parts)
    members = members.join(classes.select("doc_id", "signature", "bands"), "doc_id").join(known, "doc_id").select(
        "band", "low", "high", "own", "doc_id", "component", "signature", "bands", "text")

    def tile(rows: pa.Table) -> pa.Table:
        own, low, high = (rows[c].to_numpy() for c in ("own", "low", "high"))
        ids, part, sig = rows["doc_id"].to_numpy(), rows["component"].to_numpy(), signed(rows["signature"])
        bands = np.array(rows["bands"].to_pylist(), np.int64).reshape(len(rows), -1)
        here = (bands == rows["band"].to_numpy()[:, None]).argmax(axis=1)
        lefts, rights = np.flatnonzero(own == low), np.flatnonzero(own == high)
        a, b, sure = [], [], []
        for i in lefts:
            js = rights[(part[rights] != part[i]) & ((low[0] != high[0]) | (ids[rights] > ids[i]))]
            js = js[(bands[js] == bands[i]).argmax(axis=1) == here[i]]
            alive, agree = survivors(np.broadcast_to(sig[i], (len(js), HASHES)), sig[js], least)
            a.append(np.full(len(alive), i))
            b.append(js[alive])
            sure.append(agree)
        a, b, sure = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, sure))
        links, root, full = [], {}, full_sets(rows["text"], np.union1d(a, b), k)

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for e in np.argsort(-sure, kind="stable"):
            x, y = find(part[a[e]]), find(part[b[e]])
            if x != y and linked(full[a[e]], full[b[e]], percent):
                root[max(x, y)] = min(x, y)
                links.append(e)
        return pa.table({"a": pa.array(ids[a[links]], pa.int64()), "b": pa.array(ids[b[links]], pa.int64())})

    links = members.groupBy("band", "low", "high").applyInArrow(tile, "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def full_sets(column: pa.ChunkedArray, wanted: np.ndarray, k: int) -> dict[int, set]:
    """The shingle hashes of some texts."""
    data, offsets = texts(column.take(pa.array(wanted, pa.int64())))
    found = {}
    for i, j, d, o in slices(data, offsets):
        h, first = shingles(d, o, k)
        for t in range(i, j):
            found[int(wanted[t])] = set(h[first[t - i]:first[t - i + 1]].tolist())
    return found


def linked(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def verify(pairs: DataFrame, found: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def shingled(text: str) -> set:
        words = text.encode().translate(LOWER).split()
        return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, last, known = [], None, set()
            for i, (left, right) in enumerate(zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())):
                if left != last:
                    last, known = left, shingled(left)
                other = shingled(right)
                both = len(known & other)
                if other and 100 * both >= percent * (len(known) + len(other) - both):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    ends = [found.select(F.col("doc_id").alias(e), F.col("text").alias(f"text_{e}")) for e in "ab"]
    return pairs.join(ends[1], "b").join(ends[0], "a").select("a", "b", "text_a", "text_b").mapInArrow(
        task, "a long, b long").distinct()


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row per document, links in components."""
    spark = docs.sparkSession
    threshold = percent / 100

    def written(df: DataFrame, name: str) -> DataFrame:
        return write_work_table(df, fresh_folder(spark, f"near-{name}"))

    every = written(sets(docs, k, bands_for(threshold)), "sets")
    own = ["n_shingles", "set_a", "set_b"]
    filled = every.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy(*own).agg(
        F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature"), F.min("bands").alias("bands")), "classes")
    banded = classes.select("doc_id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
    buckets = written(banded.join(shared.drop("n"), "band"), "buckets").dropDuplicates(["band", "doc_id"])
    known = docs.select("doc_id", "text").join(buckets.select("doc_id").distinct(), "doc_id", "left_semi")
    known = written(known, "texts")

    stars = buckets.where("least <> doc_id").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = written(verify(prune(stars, classes, threshold), known, k, percent), "links")
    parts = components(links)
    more = written(cross(buckets, classes, known, parts, k, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        parts = components(links)
    class_of = classes.select(*own, F.col("doc_id").alias("least"))
    out = every.select("doc_id", *own).join(class_of, own, "left")
    out = out.withColumn("least", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")))
    # One id may stand on rows of several sets, which then are one vertex.
    same = written(out.where("doc_id <> least").select(F.col("doc_id").alias("a"), F.col("least").alias("b")).join(
        classes.select(F.col("doc_id").alias("a")).distinct(), "a", "left_semi").distinct(), "same")
    if not same.isEmpty():
        parts = components(links.unionByName(same))
    out = out.join(parts.withColumnRenamed("id", "least"), "least", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "least").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without those that have a smaller id among their near-duplicates."""
    gone = near_duplicates(docs, k, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op7_minhash_bayes(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 2, 1))) AS i
        FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, y AS other FROM edges
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
least_one AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.other, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(l.other, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_one l ON l.doc_id = w.doc_id
"""
