"""Mixing sources to target weights, with DataFrame functions only.

The documents of a source, one behind the other, make one stream of words, cut into blocks
of a fixed length, the last of which may be shorter; a source of few words has shorter blocks, so
that it can be met, too. A source's target gives its number of slots: as many as come nearest to
it in words, given where the last block lies among them. Every slot falls into an output shard at random, so the counts of a source over the shards are one multinomial draw;
within a source the slots are numbered through the shards, and slot k takes the block at
place k mod n of a pseudorandom permutation of the source's n blocks, a new one every n
slots. A block is thus taken at most once more than any other of its source.

Rows and skew: a source may hold a third of all rows, so prefix sums go over (source, bucket),
buckets by id and text, so that rows without id spread, and then over buckets, slots are made in chunks, and the last join is by (source, block).
One task sees one row per source, or one row per bucket or shard of a source.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a
source of its own and comes last; rows with equal doc_id (or none) stay rows of their own, in
order of size and text; other columns are ignored; very long texts count whole, and only words
of theirs move; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.llm.text import space_words, spread
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

SEED = 20261
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 64
LEAST_BLOCKS = 32  # blocks of a source that is too small for so many long ones are shorter
SHARD_SLOTS = 4096
BUCKET_ROWS = 2048
CHUNK = 1 << 15
ROUNDS = 12


def _key(source: str | Column) -> Column:
    """A join key without nulls: null sources share one key that no name has."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Words to take from each source: (key, source, source_size, weight, target).

    sizes: (key, source, source_size), a row per source. Weights repeat along the sources in
    code point order. A target stops at `most` times its source; the rest is shared again by
    weight. In the order of size to weight, the sources that stop come first, and all others
    get their weight times one level.
    """
    every = Window.partitionBy()
    place = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("rank", F.row_number().over(place)).withColumn(
        "weight", F.element_at(pick, (F.col("rank") - 1) % len(weights) + 1))
    ranked = ranked.withColumns({
        "top": F.col("source_size") * F.lit(most),
        "ratio": F.col("source_size") * F.lit(most) / F.col("weight"),
        "budget": F.sum("source_size").over(every) * F.lit(share)})
    order = Window.partitionBy().orderBy("ratio", "rank")
    ranked = ranked.withColumns({
        "before": F.coalesce(
            F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    ranked = ranked.withColumn(
        "stops", F.col("top") * F.col("left") <= F.col("weight") * (F.col("budget") - F.col("before")))
    level = F.min(F.when(~F.col("stops"), F.struct(
        "ratio", "rank", ((F.col("budget") - F.col("before")) / F.col("left")).alias("level")))).over(every)
    ranked = ranked.withColumn("level", level["level"])
    target = F.when(F.col("stops"), F.col("top")).otherwise(F.col("weight") * F.col("level"))
    return ranked.select("key", "source", "source_size", "weight", target.alias("target"))


def shuffled(df: DataFrame, place: str, count: str, key: list[str], seed: int = SEED, back: bool = False) -> DataFrame:
    """Maps `place` by a pseudorandom permutation of 0 .. count - 1 that depends on `key`, or back.

    Swap-or-not: each round pairs x with (k - x) mod count and swaps the pair or not, by one
    hashed bit of the larger of both. Every round is its own inverse, whatever the count is.
    """
    n = F.col(count)

    def swap(x: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), i, *key), n) - x, n)
        bit = F.xxhash64(F.lit(seed + 1), i, *key, F.greatest(x, other)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(x)

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return df.withColumn(place, F.aggregate(rounds, F.col(place).cast("long"), swap))


def _block_length(source_size: Column, block_words: int) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(source_size / LEAST_BLOCKS))).cast("long")


def _placed(rows: DataFrame, sums: DataFrame, block_words: int) -> DataFrame:
    """Adds `start`, the place of a row's first word in the stream of its source, and `length`, the
    words of the source's blocks."""
    inner = Window.partitionBy("key", "bucket").orderBy("doc_id", "size", "name").rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("words").over(Window.partitionBy("key"))
    bases = sums.select("key", "bucket", F.coalesce(F.sum("words").over(outer), F.lit(0)).alias("base"),
                        _block_length(whole, block_words).alias("length"))
    inside = rows.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return inside.join(bases, ["key", "bucket"]).withColumn("start", F.col("base") + F.col("inside")).drop(
        "base", "inside", "bucket", "name")


def slots_of(wanted: DataFrame, block_words: int, seed: int = SEED) -> DataFrame:
    """Adds `n_blocks` and `slots`, the number of slots whose words come nearest to the target.

    Whole rounds over the blocks give whole sources. Of the round after them, the slots before the
    one that takes the shorter last block give full blocks.
    """
    size, length = F.col("source_size"), _block_length(F.col("source_size"), block_words)
    plan = wanted.where("source_size > 0").withColumns({
        "length": length, "n_blocks": F.ceil(size / length), "epoch": F.floor(F.col("target") / size)})
    plan = shuffled(plan.withColumn("last", F.col("n_blocks") - 1), "last", "n_blocks", ["key", "epoch"], seed, back=True)
    left = F.col("target") - F.col("epoch") * size
    short = F.col("n_blocks") * F.col("length") - size

    def nearest(low: Column, high: Column, words_less: Column) -> Column:
        """The number of slots in a range that comes nearest, and how near."""
        k = F.least(high, F.greatest(low, F.round((left + words_less) / F.col("length")).cast("long")))
        return F.struct(F.abs(k * F.col("length") - words_less - left).alias("off"), k.alias("k"))

    before = nearest(F.lit(0).cast("long"), F.col("last"), F.lit(0).cast("long"))
    behind = nearest(F.col("last") + 1, F.col("n_blocks"), short)
    return plan.withColumn("slots", F.col("epoch") * F.col("n_blocks") + F.least(before, behind)["k"])


def _pieces(placed: DataFrame, with_text: bool) -> DataFrame:
    """One row for each document and each block that it reaches into."""
    length = F.col("length")
    first = F.floor(F.col("start") / length)
    last = F.floor((F.col("start") + F.col("size") - 1) / length)

    def piece(block: Column) -> Column:
        low = F.greatest(F.col("start"), block * length)
        high = F.least(F.col("start") + F.col("size"), (block + 1) * length)
        fields = [block.alias("block"), (low - block * length).alias("at"), (high - low).alias("n")]
        if with_text:
            words = F.slice("words", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
            fields.append(F.array_join(words, " ").alias("part"))
        return F.struct(*fields)

    used = placed.where("size > 0")
    if with_text:
        # Two uses of `words` keep the split out of the function below.
        used = used.where(F.size("words") == F.col("size"))
    return used.select("key", "doc_id", "start", F.inline(F.transform(F.sequence(first, last), piece)))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, *,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
        with_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Mixes documents (doc_id, text, source) to `share` times their words.

    Returns (mixed, documents). mixed has a row per slot: shard, position in the shard,
    source, epoch, block, n_words, pieces (at, doc_id, start, n; in block order) and, with
    text, the block's text, words joined by a space. documents has doc_id, source, key, size,
    start and its source's source_size and target.
    """
    spark = docs.sparkSession
    name = F.xxhash64("text").alias("name")
    sized = docs.select("doc_id", "source", _key("source").alias("key"), name,
                        F.size(space_words("text")).cast("long").alias("size"))
    table = write_work_table(sized, fresh_folder(spark, "mix-sizes"))
    buckets = max(1, -(-table.count() // BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64("doc_id", "name"), F.lit(buckets)).alias("bucket")
    rows = table.select("*", bucket)
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    sizes = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    wanted = targets(sizes, weights, share, most)

    plan = slots_of(wanted, block_words, seed).select("key", "source", "n_blocks", "slots")
    plan = plan.withColumn("shards", F.greatest(F.lit(1), F.ceil(
        F.sum("slots").over(Window.partitionBy()) / shard_slots))).where("slots > 0")

    chunks = spread(plan.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK)))), "key", "chunk")
    drawn = chunks.select("key", "source", "n_blocks", "shards", F.explode(F.sequence(
        F.col("chunk") * CHUNK, F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK) - 1)).alias("slot"))
    shard = F.pmod(F.xxhash64(F.lit(seed), "key", "slot"), F.col("shards"))
    counts = drawn.groupBy("key", "source", "n_blocks", shard.alias("shard")).agg(F.count("*").alias("drawn"))
    along = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("drawn").over(along), F.lit(0)))
    counts = spread(counts, "key", "shard")
    slot = counts.select("key", "source", "n_blocks", "shard", F.explode(F.sequence(
        F.col("first"), F.col("first") + F.col("drawn") - 1)).alias("slot"))
    slot = slot.withColumn("epoch", F.floor(F.col("slot") / F.col("n_blocks"))).withColumn(
        "block", F.pmod("slot", "n_blocks"))
    slot = shuffled(slot, "block", "n_blocks", ["key", "epoch"], seed)
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "key", "slot"), "key", "slot")
    slot = slot.withColumn("position", F.row_number().over(order) - 1)

    placed = _placed(rows, sums, block_words)
    if with_text:
        texts = docs.select("doc_id", _key("source").alias("key"), name, space_words("text").alias("words"))
        texts = texts.select("doc_id", "key", "name", "words", F.size("words").cast("long").alias("size"), bucket)
        parts = _pieces(_placed(texts, sums, block_words), True)
    else:
        parts = _pieces(placed, False)
    gathered = F.sort_array(F.collect_list(F.struct("at", "doc_id", "start", "n", *["part"] * with_text)))
    made = parts.groupBy("key", "block").agg(gathered.alias("pieces"), F.sum("n").alias("n_words"))
    if with_text:
        made = made.withColumn("text", F.array_join(F.col("pieces.part"), " "))
    # The planner takes slots for as few as the sources they are made from.
    mixed = slot.hint("merge").join(made, ["key", "block"])
    columns = ["shard", "position", "source", "key", "epoch", "block", "n_words", "pieces"]
    documents = placed.drop("length").join(wanted.select("key", "source_size", "target"), "key")
    return mixed.select(*columns, *["text"] * with_text), documents


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; hashes fix the draw, so that tests hold it against a
    mix made block by block in plain Python."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    mixed, documents = mix(docs, with_text=False)
    piece = mixed.select("key", F.explode("pieces").alias("p"))
    taken = piece.groupBy("key", F.col("p.doc_id").alias("taken_id"), F.col("p.start").alias("taken_at")).agg(
        F.sum("p.n").alias("taken"))
    place = F.when(documents["size"] > 0, documents["start"])
    joined = documents.join(taken, (documents["key"] == taken["key"]) & (place == taken["taken_at"])
                            & documents["doc_id"].eqNullSafe(taken["taken_id"]), "left")
    return joined.select(documents["doc_id"], "source", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The mixed corpus as rows to train on: each block with its text and its documents."""
    return mixed.select("shard", "position", "source", "epoch", "block", "n_words",
                        F.col("pieces.doc_id").alias("doc_ids"), "text")
