"""Conversation prefix trie from vertical bitmaps.

Conversations are dealt into shards by id, SHARD_CONVS ids each, and long ones into segments of
SEGMENT_TURNS positions. A shard's index maps (position, turn) to a bitset over its
conversations. From the conversations that share all turns before the segment, a depth-first
walk intersects a parent's bitset with the postings at the next position: each intersection
that is not empty is a child, its popcount the members, its members of that length the ends.
Children are found by their lowest conversation that is left, so a walk costs one intersection
a node and not one for every posting.

Nodes of all shards meet by name: two 64-bit Zobrist sums (XOR of hashes of (position, turn)),
so that a segment's start follows from whole segments before it. Members are summed, the
smallest id is the owner of a node. A conversation owns the lower end of its path, from some
depth on; what a subtree holds is then the owner's own values from that depth down, and, of each
other member of the node, all that it owns. The second part is a sum of weights under the
bitsets that the walks left. End lists stream through one digest per node, shard by shard,
since ids ascend with the shards.

Skew: a first turn that a third of all conversations share is one row per shard in every sum.
A conversation with a third of all turns is numbered by ranges (`turns`) and walked by segments;
its prefix sums cross segments, not turns. A task sees a bounded part of a shard at a time, and
end lists in chunks of a shard.

Defined cases: null roles and texts are empty; rows without conv_id belong to no conversation;
turns that tie are ordered by role, then SHA-256 of the text; repeated rows are turns of their
own; texts only enter as digest and length, so that long ones never move; a conversation that
loses all turns is a member of the root; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.llm.text import table
from chartfold.llm.turns import numbered
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table

SHARD_CONVS = 256
SEGMENT_TURNS = 64
KEY = ["depth", "k1", "k2"]
LOCAL = ("shard long, segment long, depth long, k1 long, k2 long, p1 long, p2 long, owner long, members long,"
         " chars long, bits binary, ends array<long>")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, depth, name, chars) of rebuilt conversations, and a row of depth 0, without
    a name, for each of them. A turn's name is a digest of role and text.

    Conversation c takes the first h turns of conversation c - c % 100, then its own after its
    first h; h = crc32(c) % 6. At most 199 conversations share the turns of one.
    """
    name = F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)).alias("name")
    chars = F.char_length("text").cast("long").alias("chars")
    own = write_work_table(numbered(conversations.where("conv_id IS NOT NULL"), name, chars),
                           fresh_folder(conversations.sparkSession, "own-turns"))
    ids = own.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), _taken("conv_id").alias("h"))
    first = own.where("pos <= 5").select(F.col("conv_id").alias("base"), "pos", "name", "chars")
    from_base = ids.join(first, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "name", "chars")
    lengths = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    heads = ids.join(lengths, "base", "left").select(
        F.col("conv_id").alias("of"), F.least("h", F.coalesce("n_base", F.lit(0))).alias("held"))
    later = own.where(F.col("pos") > _taken("conv_id"))
    kept = later.join(heads, later["conv_id"] == heads["of"]).select(
        "conv_id", (F.col("pos") - _taken("conv_id") + F.col("held")).alias("depth"), "name", "chars")
    roots = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("name"),
                       F.lit(0).cast("long").alias("chars"))
    return from_base.unionByName(kept).unionByName(roots)


def _taken(conv_id: str) -> Column:
    return F.crc32(F.col(conv_id).cast("string")) % 6


def _placed(turns: DataFrame, shard_convs: int, segment_turns: int) -> DataFrame:
    """Turns with their shard, segment and Zobrist hashes."""
    zobrist = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(lane), "depth", "name")).otherwise(0) for lane in (1, 2)]
    return turns.select(
        F.floor(F.col("conv_id") / shard_convs).alias("shard"),
        F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / segment_turns).alias("segment"), "conv_id", "depth",
        F.substring("name", 1, 16).alias("turn"), zobrist[0].alias("z1"), zobrist[1].alias("z2"), "chars")


def _segments(turns: DataFrame) -> DataFrame:
    """A row per conversation and segment: the Zobrist sums of all segments before, its number
    of turns, and whether it is the last."""
    sums = turns.groupBy("shard", "segment", "conv_id").agg(
        F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.max("depth").alias("top"))
    path = Window.partitionBy("conv_id").orderBy("segment")
    before = path.rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "shard", "segment", "conv_id", "top",
        *[F.coalesce(F.bit_xor(z).over(before), F.lit(0)).alias(s) for z, s in (("z1", "s1"), ("z2", "s2"))],
        F.lead("segment").over(path).isNull().alias("last"))


def walk(turns: pa.Table, starts: pa.Table) -> Iterator[tuple]:
    """Nodes of one segment of one shard, depth first: (depth, name, parent's name, owner, members,
    chars, bits, ends). Bit i of a bitset stands for the shard's i-th id in `starts`."""
    starts = starts.sort_by("conv_id")
    ids = starts["conv_id"].to_pylist()
    slot = {c: i for i, c in enumerate(ids)}
    postings: dict[tuple, int] = {}
    at: list[dict[int, bytes]] = [{} for _ in ids]
    what, whole = {}, 0
    low = None
    for conv, depth, turn, z1, z2, chars in zip(
            *(turns[c].to_pylist() for c in ("conv_id", "depth", "turn", "z1", "z2", "chars")), strict=True):
        i = slot[conv]
        if turn is None:
            whole |= 1 << i
            continue
        postings[depth, turn] = postings.get((depth, turn), 0) | 1 << i
        what[depth, turn] = z1, z2, chars
        at[i][depth] = turn
        low = depth if low is None else min(low, depth)
    ending: dict[int, int] = {}
    for i, (top, last) in enumerate(zip(starts["top"].to_pylist(), starts["last"].to_pylist(), strict=True)):
        if last:
            ending[top] = ending.get(top, 0) | 1 << i

    def members(bits: int) -> list[int]:
        found = []
        while bits:
            found.append(ids[(bits & -bits).bit_length() - 1])
            bits &= bits - 1
        return found

    def node(depth, name, parent, bits, chars):
        return (depth, *name, *parent, ids[(bits & -bits).bit_length() - 1], bits.bit_count(), chars,
                bits.to_bytes(-(-len(ids) // 8), "little"), members(bits & ending.get(depth, 0)))

    stack = []
    if whole:  # the segment with the root; all paths begin in it
        yield node(0, (0, 0), (None, None), whole, 0)
        stack.append((0, (0, 0), whole))
    else:
        roots: dict[tuple, int] = {}
        for i, name in enumerate(zip(starts["s1"].to_pylist(), starts["s2"].to_pylist(), strict=True)):
            roots[name] = roots.get(name, 0) | 1 << i
        stack += [(low - 1, name, bits) for name, bits in roots.items()]
    while stack:
        depth, name, bits = stack.pop()
        left = bits & ~ending.get(depth, 0)
        while left:
            turn = at[(left & -left).bit_length() - 1].get(depth + 1)
            if turn is None:  # the path goes on in the next segment, with all that are left
                break
            child = bits & postings[depth + 1, turn]
            z1, z2, chars = what[depth + 1, turn]
            key = name[0] ^ z1, name[1] ^ z2
            yield node(depth + 1, key, name, child, chars)
            stack.append((depth + 1, key, child))
            left &= ~child


def local_nodes(turns: DataFrame, segments: DataFrame) -> DataFrame:
    """All shards' nodes, one row for each node and shard that has members of it."""
    schema = pa.schema([
        *[(c, pa.int64()) for c in ("shard", "segment", "depth", "k1", "k2", "p1", "p2", "owner", "members", "chars")],
        ("bits", pa.binary()), ("ends", pa.list_(pa.int64()))])

    def nodes(key, turns: pa.Table, starts: pa.Table) -> pa.Table:
        shard, segment = (k.as_py() for k in key)
        rows = [(shard, segment, *found) for found in walk(turns, starts)]
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return turns.groupBy("shard", "segment").cogroup(segments.groupBy("shard", "segment")).applyInArrow(nodes, LOCAL)


def _ends(local: DataFrame) -> DataFrame:
    """The digest of the ids that end at each node, which stream past in order."""
    schema = pa.schema([*[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in (*KEY, "ends")), strict=True)

        rows = []
        for key, lists in itertools.groupby(chunks(), key=lambda r: r[:3]):
            made, mark = hashlib.sha256(), ""
            for *_, ids in lists:
                made.update((mark + ",".join(map(str, ids))).encode())
                mark = ","
            rows.append((*key, made.hexdigest()))
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)  # noqa: B905
                rows = []
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    lists = local.where(F.size("ends") > 0).select(*KEY, "shard", "ends")
    sent = lists.repartition(*KEY).sortWithinPartitions(*KEY, "shard")
    return sent.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def _below(local: DataFrame, weights: DataFrame) -> DataFrame:
    """For each node, the weights of its members but its owner, summed: first under the bitsets
    of the shards, then over the shards."""
    sums = "depth long, k1 long, k2 long, leaves long, saved long"
    schema = pa.schema([(c.split()[0], pa.int64()) for c in sums.split(", ")])

    def under(key, nodes: pa.Table, owned: pa.Table) -> pa.Table:
        at = owned["at"].to_numpy()
        values = np.stack([owned["leaves"].to_numpy(), owned["saved"].to_numpy()]) if len(at) else np.zeros((2, 0), np.int64)
        if not nodes.num_rows or not len(at):
            return schema.empty_table()
        raw = np.frombuffer(b"".join(nodes["bits"].to_pylist()), np.uint8).reshape(nodes.num_rows, -1)
        held = (raw[:, at >> 3] >> (at & 7).astype(np.uint8)) & 1
        # A conversation weighs in at nodes above those it owns.
        held = held & (nodes["depth"].to_numpy()[:, None] < owned["depth"].to_numpy()[None, :])
        total = held.astype(np.int64) @ values.T
        some = np.flatnonzero(held.any(axis=1))
        return pa.table([nodes[k].take(pa.array(some)) for k in KEY] + [pa.array(total[some, i]) for i in (0, 1)], schema=schema)

    shared = local.select("shard", "segment", *KEY, "bits")
    found = shared.groupBy("shard", "segment").cogroup(weights.groupBy("shard", "segment")).applyInArrow(under, sums)
    return found.groupBy(*KEY).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def prefix_trie(turns: DataFrame, shard_convs: int = SHARD_CONVS, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Nodes of the trie over turns (conv_id, depth, name, chars), rows of depth 0 included."""
    spark = turns.sparkSession
    turns = write_work_table(_placed(turns, shard_convs, segment_turns), fresh_folder(spark, "trie-turns"))
    segments = write_work_table(_segments(turns), fresh_folder(spark, "trie-segments"))
    local = write_work_table(local_nodes(turns, segments), fresh_folder(spark, "trie-local"))
    nodes = local.groupBy(*KEY).agg(
        F.min("owner").alias("conv_id"), F.sum("members").alias("n_convs"), F.max("chars").alias("chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = write_work_table(nodes, fresh_folder(spark, "trie-nodes"))
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    joined = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    segment = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / segment_turns)
    owned = joined.select(
        *KEY, "p1", "p2", "conv_id", "n_convs", "n_children", segment.alias("segment"),
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saving"))
    owned = write_work_table(owned, fresh_folder(spark, "trie-owned"))

    # What an owner holds from a depth down: of this segment and of the segments below.
    per_segment = owned.groupBy("conv_id", "segment").agg(
        F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"), F.min("depth").alias("depth"))
    down = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    lower = per_segment.select(
        "conv_id", "segment", *[F.coalesce(F.sum(c).over(down), F.lit(0)).alias(f"lower_{c}") for c in ("leaf", "saving")])
    inside = Window.partitionBy("conv_id", "segment").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = owned.withColumns({c: F.sum(c).over(inside) for c in ("leaf", "saving")}).join(lower, ["conv_id", "segment"])

    totals = per_segment.groupBy("conv_id").agg(
        F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"), F.min("depth").alias("owns"))
    slots = segments.select("shard", "segment", "conv_id", (F.row_number().over(
        Window.partitionBy("shard", "segment").orderBy("conv_id")) - 1).cast("long").alias("at"))
    top_segment = F.floor(F.greatest(F.col("owns") - 2, F.lit(0)) / segment_turns)
    weights = slots.join(totals.where("owns > 0"), "conv_id").where(F.col("segment") <= top_segment).select(
        "shard", "segment", "at", "leaves", "saved", F.col("owns").alias("depth"))
    more = _below(local, weights)

    parents = owned.select(F.col("depth").alias("up"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    placed = own.withColumn("up", F.col("depth") - 1).join(parents, ["up", "p1", "p2"], "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return placed.join(more, KEY, "left").join(_ends(local), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.col("lower_leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saving") + F.col("lower_saving") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


ORACLE = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, xor(list_reduce(
      [4294967295::BIGINT] || list_transform(generate_series(1, length(conv_id::VARCHAR)), lambda i: ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INTEGER), 1))::BIGINT),
      lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM own GROUP BY conv_id),
turns AS (
  SELECT i.conv_id, pos AS depth, role, text FROM ids i JOIN own o ON o.conv_id = i.base AND o.pos <= i.h
  UNION ALL
  SELECT o.conv_id, o.pos - i.h + least(i.h, coalesce(b.n, 0)), o.role, o.text
  FROM own o JOIN ids i USING (conv_id) LEFT JOIN ids b ON b.conv_id = i.base WHERE o.pos > i.h),
paths AS (
  SELECT conv_id, depth, length(text) AS chars,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth),
linked AS (
  SELECT c.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = c.depth + 1
      AND k.path[1:64 * c.depth] = c.path) AS n_children
  FROM nodes c LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:64 * (c.depth - 1)])
SELECT u.conv_id, u.depth, u.parent_conv_id, u.n_convs, u.n_children, u.ends_sha256,
  CAST(sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
  CAST(sum((w.n_convs - 1) * w.chars) AS BIGINT) AS saved_tokens
FROM linked u JOIN linked w ON w.depth >= u.depth AND w.path[1:64 * u.depth] = u.path
GROUP BY u.path, u.conv_id, u.depth, u.parent_conv_id, u.n_convs, u.n_children, u.ends_sha256
"""
