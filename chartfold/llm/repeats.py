"""Which windows of documents occurred before: the exchange that both repeat removers use.

A document is a sequence of items (words, or bytes); a window is L items in a row. An
operator names for every window one place inside it that depends on nothing but the window's
content. All windows with the same place make a record, which has a `name` (hash of the items
around the place that each of its windows holds) and a `whole` (hash of all items of the
record and of where the place lies in it). Equal windows therefore lie in records of equal
name. That gives three passes over the texts, which are shuffled once, by chunk:

1. Each chunk of documents sends one entry per different record to the range of its name.
   There, a name with one `whole` is settled: all its windows are equal, the least document
   is their first. A name with several is open: its records share some windows at most.
2. First records of open names send the hashes of their single windows the same way.
3. With both answers each chunk knows every window that occurred before.

An entry has 14 bytes, and a name that a third of all documents hold costs one entry per
chunk and content, not one per occurrence. Hashes have 64 bits.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartfold.llm.grams import U, mixed, owners, slices, texts, window_hash

CHUNK_ROWS = 1024
ROWS = 256  # rows without id that are finished at once
RANGE_ROWS = 2048
CHUNK, SIZE = "__chunk", "__size"  # added to the rows while they are judged
ENTRIES = "bucket int, chunk int, phase int, names binary, wholes binary, of binary, ids binary"
ANSWERS = "chunk int, phase int, bucket int, at binary, first binary, open binary"


@dataclass
class Kind:
    """What an operator says of its sequences.

    parse(bytes, offsets) gives items and the n + 1 places of documents in them; place(items,
    starts) the place of each window; a record's name covers the items from place + near to
    place + far; within: whether earlier windows of the same document count.
    """

    window: int
    parse: Callable
    place: Callable
    near: int
    far: int
    within: bool


@dataclass
class Records:
    """Records of some documents: item numbers count from the start of the first of them."""

    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    name: np.ndarray
    whole: np.ndarray

    def where(self, wanted: np.ndarray) -> Records:
        return Records(*(getattr(self, n)[wanted] for n in ("of", "low", "high", "name", "whole")))


def records(kind: Kind, items: np.ndarray, first: np.ndarray) -> Records:
    of = owners(first)
    starts = np.arange(len(items))
    fits = starts + kind.window <= first[1:][of]
    starts, of = starts[fits], of[fits]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Records(none, none, none, none.astype(U), none.astype(U))
    place = kind.place(items, starts)
    begins = np.ones(len(starts), bool)
    begins[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(begins)
    low, place = starts[at], place[at]
    high = starts[np.append(at[1:], len(starts)) - 1]
    # Mixed once more: an operator may choose places by small hashes, and names must be even.
    name = mixed(window_hash(items, place + kind.near, place + kind.far) ^ U(0x5851F42D4C957F2D))
    whole = window_hash(items, low, high + kind.window)
    whole = mixed(whole + (place - low).astype(U) * U(0xA24BAED4963EE407) + name)
    return Records(of[at], low, high, name, whole)


class Chunk:
    """A chunk's documents in the order of their ids, parsed once; rows without id have no records."""

    def __init__(self, kind: Kind, rows: pa.Table):
        ids = rows["doc_id"].cast(pa.int64())
        known = ids.is_valid().to_numpy()
        ids = ids.fill_null(0).to_numpy()
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids = unpacked(rows.take(pa.array(order))), ids[order]
        known = known[order]
        self.kind = kind
        self.data, self.offsets = texts(self.rows["text"])
        made = []
        for i, j, d, o in slices(self.data, self.offsets):
            items, first = kind.parse(d, o)
            r = records(kind, items, first)
            r = r.where(known[r.of + i])
            r.of += i
            made.append((i, j, first, r))
        self.slices = [(i, j, first) for i, j, first, _ in made]
        self.counts = np.concatenate([np.diff(f) for _, _, f, _ in made] or [np.zeros(0, np.int64)])
        self.sizes = [len(r.of) for *_, r in made]
        self.records = Records(*(np.concatenate([getattr(r, n) for *_, r in made]) if made else np.zeros(0, np.int64)
                                 for n in ("of", "low", "high", "name", "whole")))

    def items(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        i, j, _ = self.slices[k]
        cut = self.offsets[i:j + 1]
        return self.kind.parse(self.data[cut[0]:cut[-1]], cut - cut[0])


class Keys:
    """The different (name, whole) of a chunk, in that order, cut into buckets by name.

    least: the first row that holds a key; at: each record's key.
    """

    def __init__(self, name: np.ndarray, whole: np.ndarray, of: np.ndarray, splitters: np.ndarray):
        order = np.lexsort((of, whole, name))
        n, w = name[order], whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (n[1:] != n[:-1]) | (w[1:] != w[:-1])
        self.name, self.whole = n[new], w[new]
        self.first_record = order[new]
        self.least = of[self.first_record]
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.edges = np.concatenate([[0], np.searchsorted(self.name, splitters), [len(self.name)]])

    def entries(self, chunk: int, phase: int, ids: np.ndarray) -> Iterator[dict]:
        for bucket in np.flatnonzero(np.diff(self.edges)):
            cut = slice(self.edges[bucket], self.edges[bucket + 1])
            used, of = np.unique(self.least[cut], return_inverse=True)
            # A window's name is its content, which need not be sent twice.
            names = self.name[cut].astype(np.uint32).tobytes() if phase == 1 else b""
            yield {"bucket": int(bucket), "chunk": chunk, "phase": phase, "names": names,
                   "wholes": self.whole[cut].tobytes(),
                   "of": of.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes(),
                   "ids": ids[used].tobytes()}

    def answered(self, ids: np.ndarray, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """For each key the first document that holds it, and whether its name is open."""
        first, is_open = ids[self.least], np.zeros(len(self.least), bool)
        for a in answers:
            at = np.frombuffer(a["at"], np.uint32).astype(np.int64) + self.edges[a["bucket"]]
            first[at] = np.frombuffer(a["first"], np.int64)
            is_open[at] = np.frombuffer(a["open"], bool)
        return first, is_open


def give_back() -> None:
    """Returns what an earlier group left free in this worker to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the shuffle and the ways between the JVM and Python."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        raw = [None if x is None else x.encode() for x in batch.column("text").to_pylist()]
        sizes = pa.array([None if x is None else len(x) for x in raw], pa.int64())
        small = pa.array([None if x is None else codec.compress(x, asbytes=True) for x in raw], pa.binary())
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", small).append_column(SIZE, sizes)


def unpacked(rows: pa.Table) -> pa.Table:
    codec = pa.Codec("zstd", 1)
    pairs = zip(rows["text"].to_pylist(), rows[SIZE].to_pylist())
    raw = [None if x is None else codec.decompress(x, n, asbytes=True) for x, n in pairs]
    text = pa.array(raw, pa.large_binary()).cast(pa.large_string())
    return rows.set_column(rows.schema.get_field_index("text"), "text", text).drop_columns([SIZE])


def settle(whole: pa.Table) -> pa.Table:
    """One range of names: answers for all entries that are not the first of their content, or
    whose name has several contents. An entry without an answer is the first.

    The sort goes key by key: by name, then equal names by content, then by document.
    """
    give_back()
    sent = whole.to_pylist()
    del whole
    wholes = np.concatenate([np.frombuffer(s["wholes"], U) for s in sent])
    named = sent[0]["phase"] == 1
    names = np.concatenate([np.frombuffer(s["names"], np.uint32) for s in sent]) if named else wholes
    sizes = [len(s["wholes"]) // 8 for s in sent]
    docs = np.concatenate([
        np.frombuffer(s["ids"], np.int64)[np.frombuffer(s["of"], np.uint16 if len(s["ids"]) <= 8 << 16 else np.uint32)]
        for s in sent])
    order = np.argsort(names, kind="stable")
    n = names[order]
    same = np.zeros(len(n) + 1, bool)
    same[1:-1] = n[1:] == n[:-1]
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((docs[order], wholes[order], names[order]))]
    n, w = names[order], wholes[order]
    name_starts, key_starts = np.ones(len(n), bool), np.ones(len(n), bool)
    name_starts[1:] = n[1:] != n[:-1]
    key_starts[1:] = name_starts[1:] | (w[1:] != w[:-1])
    key = np.cumsum(key_starts) - 1
    group = np.cumsum(name_starts) - 1
    first = docs[order][key_starts][key]
    keys_of_group = np.bincount(group[key_starts], minlength=group[-1] + 1 if len(group) else 0)
    is_open = keys_of_group[group] > 1
    is_first = first == docs[order]
    is_open &= is_first & named
    told = np.flatnonzero(is_open | ~is_first)
    told = told[np.argsort(order[told])]
    at, first, is_open = order[told], first[told], is_open[told]
    ends = np.cumsum(sizes)
    cuts = np.searchsorted(at, np.concatenate([[0], ends]))
    rows = []
    for i, s in enumerate(sent):
        if cuts[i] < cuts[i + 1]:
            cut = slice(cuts[i], cuts[i + 1])
            rows.append({"chunk": s["chunk"], "phase": s["phase"], "bucket": s["bucket"],
                         "at": (at[cut] - (ends[i] - sizes[i])).astype(np.uint32).tobytes(),
                         "first": first[cut].tobytes(), "open": is_open[cut].tobytes()})
    return pa.Table.from_pylist(rows, schema=ANSWER_SCHEMA)


ANSWER_SCHEMA = pa.schema([("chunk", pa.int32()), ("phase", pa.int32()), ("bucket", pa.int32()),
                           ("at", pa.binary()), ("first", pa.binary()), ("open", pa.binary())])
ENTRY_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("phase", pa.int32()),
                          ("names", pa.binary()), ("wholes", pa.binary()), ("of", pa.binary()), ("ids", pa.binary())])


class Judge:
    """A chunk with its answers: which windows of its documents occurred before."""

    def __init__(self, kind: Kind, rows: pa.Table, answers: pa.Table, splitters: np.ndarray):
        self.kind, self.splitters = kind, splitters
        self.chunk = Chunk(kind, rows)
        r, ids = self.chunk.records, self.chunk.ids
        told = answers.to_pylist()
        self.keys = Keys(r.name, r.whole, r.of, splitters)
        first, is_open = self.keys.answered(ids, [a for a in told if a["phase"] == 1])
        doc = ids[r.of]
        self.before = doc > first[self.keys.at]
        if kind.within:
            # Records stand in order, so a key's first record in a row is its least one.
            self.before |= ~earliest(self.keys.at, r.of)
        # A first record of an open name asks for its windows one by one.
        asks = is_open[self.keys.at] & ~self.before
        self.asked = np.flatnonzero(asks)
        self.told = [a for a in told if a["phase"] == 2]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, rows and starts of the asked windows, in the order of rows and starts."""
        r, kind = self.chunk.records, self.kind
        hashes, of, starts, at = [], [], [], 0
        for k, size in enumerate(self.chunk.sizes):
            mine = self.asked[(self.asked >= at) & (self.asked < at + size)]
            at += size
            if len(mine):
                items, _ = self.chunk.items(k)
                n = r.high[mine] - r.low[mine] + 1
                s = np.repeat(r.low[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                hashes.append(window_hash(items, s, s + kind.window))
                of.append(np.repeat(r.of[mine], n))
                starts.append(s)
        if not hashes:
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(hashes), np.concatenate(of), np.concatenate(starts)

    def window_keys(self) -> tuple[Keys, np.ndarray, np.ndarray]:
        h, of, starts = self.windows()
        return Keys(h, h, of, self.splitters), of, starts

    def covered(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Slice by slice: first and last row, places of the rows, and which items lie in a
        window that occurred before."""
        r, kind, ids = self.chunk.records, self.kind, self.chunk.ids
        keys, of, starts = self.window_keys()
        first, _ = keys.answered(ids, self.told)
        late = ids[of] > first[keys.at]
        if kind.within:
            late |= ~earliest(keys.at, of)
        late_of, late_start = of[late], starts[late]
        at = 0
        for (i, j, places), size in zip(self.chunk.slices, self.chunk.sizes):
            cut = slice(at, at + size)
            at += size
            hit = self.before[cut]
            edge = np.zeros(places[-1] + 1, np.int64)
            np.add.at(edge, r.low[cut][hit], 1)
            np.add.at(edge, r.high[cut][hit] + kind.window, -1)
            mine = (late_of >= i) & (late_of < j)
            np.add.at(edge, late_start[mine], 1)
            np.add.at(edge, late_start[mine] + kind.window, -1)
            yield i, j, places, np.cumsum(edge[:-1]) > 0


def earliest(key: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which items are the first of their key in their row; items stand in the rows' order."""
    order = np.lexsort((np.arange(len(key)), of, key))
    k, o = key[order], of[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    out = np.empty(len(order), bool)
    out[order] = new
    return out


def entry_table(keys: Keys, chunk: Chunk, phase: int) -> pa.Table:
    number = chunk.rows[CHUNK][0].as_py()
    return pa.Table.from_pylist(list(keys.entries(number, phase, chunk.ids)), schema=ENTRY_SCHEMA)


def even_splitters(ranges: int) -> np.ndarray:
    """Names are hashes, so equal parts of their range hold about equally many."""
    return (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(U)


def by_place(docs: DataFrame) -> DataFrame:
    """docs with its columns but id and text named by their places, so that no name is in the way."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)))


def judged(docs: DataFrame, kind: Kind, finish: Callable[[Judge], pa.Table], schema: str,
           splitters: Callable[[int], np.ndarray] = even_splitters) -> DataFrame:
    """Runs the passes over docs (doc_id, text, others) and gives finish(judge) of each chunk.

    Rows without an id match nothing and are finished where they are read. The three passes
    read one and the same shuffle of the others.
    """
    known = docs.where("doc_id IS NOT NULL")
    n = known.count()
    chunks, ranges = -(-n // CHUNK_ROWS) or 1, -(-n // RANGE_ROWS) or 1
    cuts = splitters(ranges)
    # Rows of equal id need not meet, nor do copies of a row: both are dealt out, by what a lost
    # task finds again.
    chunk = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(chunks)).cast("int")
    dealt = known.withColumn(CHUNK, chunk)
    fields = [T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in dealt.schema.fields]
    dealt = dealt.mapInArrow(packed, T.StructType([*fields, T.StructField(SIZE, T.LongType())]))

    def first_pass(rows: pa.Table) -> pa.Table:
        give_back()
        made = Chunk(kind, rows)
        r = made.records
        return entry_table(Keys(r.name, r.whole, r.of, cuts), made, 1)

    def second_pass(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(rows):
            return ENTRY_SCHEMA.empty_table()
        give_back()
        judge = Judge(kind, rows, answers, cuts)
        return entry_table(judge.window_keys()[0], judge.chunk, 2)

    def third_pass(rows: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        judge = Judge(kind, rows, answers, cuts)
        judge.chunk.rows = judge.chunk.rows.drop_columns([CHUNK])
        return finish(judge)

    def without_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS))
        for batch in packed(few):
            judge = Judge(kind, pa.Table.from_batches([batch]), ANSWER_SCHEMA.empty_table(), cuts)
            yield from finish(judge).to_batches()

    def answers(entries: DataFrame) -> DataFrame:
        return entries.groupBy("bucket").applyInArrow(settle, ANSWERS)

    groups = dealt.groupBy(CHUNK)
    names = answers(groups.applyInArrow(first_pass, ENTRIES))
    windows = answers(groups.cogroup(names.groupBy("chunk")).applyInArrow(second_pass, ENTRIES))
    told = names.unionAll(windows)
    done = groups.cogroup(told.groupBy("chunk")).applyInArrow(third_pass, schema)
    return done.unionAll(docs.where("doc_id IS NULL").mapInArrow(without_answers, schema))
