"""Benchmark decontamination: passages within a word edit distance of a benchmark item.

An item of n words is found where some passage is at most EDITS * n words away from it. Such a
passage shares at least n - k + 1 - k * edits grams of k words with the item, near one
diagonal; places with fewer shared grams cannot hold one and are left at once. At the others,
windows of the item's size are embedded by random walks (CGK: a shared random function of step
and word says whether the walk moves on, so edit distance turns into Hamming distance), and
bit sampling compares them with the item's walk: a window is a candidate if in any of
WALKS * DRAWS draws all sampled steps agree: 4 to 2 of them, fewer for longer items. Only steps at which the item's walk still reads
a word are drawn, so that windows of other words agree in none. Candidates are verified by
exact edit distance of the item to the best passage around the window.

Recall of the sampling, on passages at the limit of edits: walks agree in 0.6 of the steps for 5
words, in 0.38 for 50, in 0.28 for 150 and in 0.18 for 400, and of 300 windows each none was missed
up to 30 words, 0.3 % at 50. Windows of repeated grams, which the count of grams cannot tell,
agree in few steps and are left here.

The documents are not shuffled. Items are sent to all tasks in blocks of ITEMS, one pass over
the documents for each block, so any number of items is handled.

Defined cases: null and empty texts hold nothing; items without words or without id are left
out; rows of equal doc_id are searched one by one and give a row each; words are compared
after lower-casing A-Z and without ASCII punctuation; an empty table gives an empty result;
other columns pass through `clean`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.grams import NAME_WORD, U, Words, mixed, slices, texts, window_hash
from chartfold.llm.text import table

EDITS = 0.2
GRAM = 3
ITEMS = 20000
WALKS, DRAWS, BITS = 16, 16, 4
# Walks of longer items agree in fewer steps at the limit of edits: (most words, bits).
FEWER_BITS = ((50, BITS), (100, 3))
LEAST_BITS = 2
PREFILTER = 20
STEPS = 4_000_000  # of all walks embedded at once, unless one item has more
FOUND = ("doc_id long, item_id long, n_item_words long, start_word long, end_word long, "
         "distance long, similarity double")


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, NAME_WORD, lower=True)


class Items:
    """Items as word hashes, with the places of their grams and their walks."""

    def __init__(self, ids: list[int], data: np.ndarray, offsets: np.ndarray, edits: float = EDITS):
        words = words_of(data, offsets)
        self.words = [words.hashes[a:b] for a, b in zip(words.first, words.first[1:])]
        self.ids = np.array(ids, np.int64)
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.floor(edits * self.n + 1e-9).astype(np.int64)
        self.k = np.array([max([1, *(k for k in range(1, GRAM + 1) if n - k + 1 - k * e >= 1)])
                           for n, e in zip(self.n, self.edits)], np.int64)
        self.need = np.maximum(1, self.n - self.k + 1 - self.k * self.edits)
        self.by_size = {}
        for k in range(1, GRAM + 1):
            mine = [(i, a) for i in np.flatnonzero((self.k == k) & (self.n >= k)) for a in range(self.n[i] - k + 1)]
            if mine:
                of, at = np.array(mine, np.int64).T
                h = np.concatenate([window_hash(self.words[i], np.arange(self.n[i] - k + 1), np.arange(k, self.n[i] + 1))
                                    for i in np.unique(of)])
                order = np.argsort(h, kind="stable")
                flags = np.zeros(1 << PREFILTER, bool)
                flags[(h >> U(64 - PREFILTER)).astype(np.int64)] = True
                self.by_size[k] = (h[order], of[order], at[order], flags)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts, items, places and places in the item of all shared grams."""
        out = []
        for k, (keys, of_item, at_item, flags) in self.by_size.items():
            places, of, h = words.grams(k)
            maybe = np.flatnonzero(flags[(h >> U(64 - PREFILTER)).astype(np.int64)])
            low, high = (np.searchsorted(keys, h[maybe], side) for side in ("left", "right"))
            n = high - low
            spot = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row = np.repeat(maybe, n)
            out.append((of[row], of_item[spot], places[row], at_item[spot]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4

    def dense(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, items and window starts near which an item has as many shared grams as it needs."""
        of, item, place, at = self.hits(words)
        order = np.lexsort((place, item, of))
        of, item, place, at = of[order], item[order], place[order], at[order]
        need = self.need[item]
        last = np.arange(len(of)) + need - 1
        inside = np.minimum(last, len(of) - 1)
        full = (last < len(of)) & (of[inside] == of) & (item[inside] == item)
        full &= place[inside] - place <= self.n[item] + self.edits[item]
        good = np.zeros(len(of) + 1, np.int64)
        np.add.at(good, np.flatnonzero(full), 1)
        np.add.at(good, last[full] + 1, -1)
        used = np.cumsum(good[:-1]) > 0
        starts = np.stack([of[used], item[used], place[used] - at[used]], axis=1)
        return tuple(np.unique(starts, axis=0).T)

    @functools.cached_property
    def walks(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled steps by item, walk and draw, and the items' own symbols at them.

        Steps are drawn below the end of the item's own walk, where the item has a word:
        a window of other words agrees in none of them.
        """
        flat = np.concatenate([*self.words, np.zeros(1, U)])
        ends = np.cumsum(self.n)
        starts = ends - self.n
        steps = np.zeros((len(self.n), WALKS, DRAWS * BITS), np.int32)
        symbols = np.zeros(steps.shape, np.uint32)
        draw = np.random.default_rng(9).random(steps.shape[1:])
        for part in portions(self.n, np.arange(len(self.n))):
            longest = 3 * int(self.n[part].max())
            every = np.broadcast_to(np.arange(longest), (len(part), WALKS, longest))
            walked = embedded(flat, starts[part], ends[part], every)
            inside = (walked != 0).sum(axis=2)
            steps[part] = draw * np.minimum(inside, 3 * self.n[part, None])[:, :, None]
            symbols[part] = np.take_along_axis(walked, steps[part].astype(np.int64), axis=2)
        return steps, symbols


def portions(n: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Rows by size, as many at once as have STEPS steps of walks in all."""
    rows = rows[np.argsort(n[rows], kind="stable")]
    while len(rows):
        most = np.arange(1, len(rows) + 1) * n[rows] * 3 * WALKS
        cut = max(1, int(np.searchsorted(most, STEPS)))
        yield rows[:cut]
        rows = rows[cut:]


def embedded(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Symbols, cut to 32 bits, of the walks from each start at the given steps; behind the end it is 0."""
    longest = int(steps.max()) + 1
    salts = np.array([[((walk << 32) + step + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for walk in range(WALKS)]
                      for step in range(longest)], U)[:, :, None]
    at = np.repeat(starts[None], WALKS, axis=0)
    symbols = np.empty((longest, *at.shape), np.uint32)
    for step in range(longest):
        inside = at < ends
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], U(0))
        symbols[step] = word
        at = at + (inside & ((mixed(word + salts[step]) & U(1)) == 1))
    return np.take_along_axis(symbols.transpose(2, 1, 0), steps, axis=2)


def distance(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to any run of the passage's words: (distance, start, end)."""
    m = len(passage)
    cost, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    for i, word in enumerate(item, 1):
        swap = cost[:-1] + (passage != word)
        drop = cost[1:] + 1
        row, start = np.empty(m + 1, np.int64), np.empty(m + 1, np.int64)
        row[0], start[0] = i, 0
        best = np.minimum(swap, drop)
        from_ = np.where(swap <= drop, begin[:-1], begin[1:])
        # Added words: the least of any earlier place plus the way from there.
        lift = np.concatenate([[i], best]) - np.arange(m + 1)
        low = np.minimum.accumulate(lift)
        source = np.maximum.accumulate(np.where(lift == low, np.arange(m + 1), 0))
        row = low + np.arange(m + 1)
        start = np.concatenate([[0], from_])[source]
        cost, begin = row, start
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def agree(words: Words, items: Items, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether all bits of any draw agree between an item and a window, for each of both."""
    drawn = np.zeros(len(item), bool)
    steps, symbols = items.walks
    sizes, bits = zip(*FEWER_BITS)
    bits = np.array([*bits, LEAST_BITS])[np.searchsorted(sizes, items.n)]
    for part in portions(items.n[item], np.arange(len(item))):
        of = item[part]
        same = embedded(words.hashes, begin[part], end[part], steps[of].astype(np.int64)) == symbols[of]
        same = same.reshape(len(part), WALKS * DRAWS, BITS) | (np.arange(BITS) >= bits[of, None, None])
        drawn[part] = same.all(axis=2).any(axis=1)
    return drawn


def search(words: Words, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, distance): the nearest passage for each text and item found."""
    of, item, start = items.dense(words)
    if not len(of):
        return
    low, high = words.first[:-1][of], words.first[1:][of]
    begin = np.clip(start, low, high)
    drawn = agree(words, items, item, begin, np.minimum(begin + items.n[item], high))
    of, item, begin = of[drawn], item[drawn], begin[drawn]
    order = np.lexsort((begin, item, of))
    of, item, begin = of[order], item[order], begin[order]
    # Windows of an item that overlap are one region: its best passage is the best of them all.
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > begin[:-1] + items.n[item[1:]])
    first = np.flatnonzero(new)
    best = {}
    for x, y in zip(first, np.append(first[1:], len(of))):
        t, i = of[x], item[x]
        low = max(words.first[t], begin[x] - items.edits[i])
        high = min(words.first[t + 1], begin[y - 1] + items.n[i] + items.edits[i])
        d, a, b = distance(items.words[i], words.hashes[low:high])
        if d <= items.edits[i]:
            offer = (d, int(low + a - words.first[t]), int(low + b - words.first[t]))
            best[(t, i)] = min(best.get((t, i), offer), offer)
    for (t, i), (d, x, y) in sorted(best.items()):
        yield int(t), int(i), x, y, d


def blocks(benchmark: DataFrame, size: int = ITEMS) -> Iterator[tuple[list[int], list[str]]]:
    """The items, block by block of at most `size`, each small enough to send to all tasks."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text")
    parts = max(1, -(-rows.count() // size))
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    for i in range(parts):
        found = rows.where(part == i).orderBy("item_id", "text").collect()
        yield [r.item_id for r in found], [r.text for r in found]


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """A row for each document and item found in it."""
    parts = []
    for ids, listed in blocks(benchmark):
        def task(batches: Iterator[pa.RecordBatch], ids=ids, listed=listed) -> Iterator[pa.RecordBatch]:
            items = Items(ids, *texts(pa.array(listed, pa.string())), edits)
            for batch in batches:
                doc_ids = batch.column("doc_id")
                data, offsets = texts(batch.column("text"))
                rows = []
                for i, _, d, o in slices(data, offsets):
                    rows += [(i + t, items.ids[x], items.n[x], a, b, e) for t, x, a, b, e in search(words_of(d, o), items)]
                if rows:
                    row, item, n, a, b, e = (np.array(c, np.int64) for c in zip(*rows))
                    columns = [pa.array(c) for c in (item, n, a, b, e)]
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.take(pa.array(row)).cast(pa.int64()), *columns, pa.array(1 - e / n)],
                        names=[f.split()[0] for f in FOUND.split(", ")])
        parts.append(docs.select("doc_id", "text").mapInArrow(task, FOUND))
    return functools.reduce(DataFrame.unionAll, parts)


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """docs without those that hold an item, judged row by row."""
    schema = docs.schema
    for ids, listed in blocks(benchmark):
        def task(batches: Iterator[pa.RecordBatch], ids=ids, listed=listed) -> Iterator[pa.RecordBatch]:
            items = Items(ids, *texts(pa.array(listed, pa.string())), edits)
            for batch in batches:
                data, offsets = texts(batch.column("text"))
                keep = np.ones(len(batch), bool)
                for i, _, d, o in slices(data, offsets):
                    for t, *_ in search(words_of(d, o), items):
                        keep[i + t] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(task, schema)
    return docs


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
