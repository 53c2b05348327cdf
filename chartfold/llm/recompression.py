"""Substring dedup by recompression: words that repeat an earlier run of words are removed.

The words of a text are symbols. Runs of one symbol count as one; then three rounds pair
neighbours: each symbol is a left or a right one by a bit of its hash, a left one directly
before a right one becomes a new symbol, named by the hash of both names. Names come from
content alone, so every task gives a pair the same name. Whether a symbol begins at a word
depends on four words on either side, and a symbol has at most eight words besides runs, so
of any 20 words in a row, wherever they stand, the same inner symbol beginnings are found:
a window is filed under the first. Beginnings that are shared reveal repeats, and hashes of
all words around them verify these (see repeats.py for the passes).

Within runs every word counts as a beginning, which keeps the rule for windows of one word.

Defined cases: null and empty texts have no words and an empty kept text; a row without id
repeats nothing and is repeated by nothing; rows of equal id are each judged alone against
smaller ids; white space between kept words becomes one space; an empty table gives an
empty result; other columns pass through `remove`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chartfold.llm.grams import U, Words, mixed
from chartfold.llm.repeats import Judge, Kind, by_place, judged
from chartfold.llm.text import table

WINDOW = 20
LEVELS = 3
REACH = 4  # words on either side that decide a beginning


def parse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(data, offsets)
    return words.hashes, words.first


def beginnings(words: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Places where a symbol of the last level begins, and all places near two equal words:
    with two within REACH words, the place could depend on a word further away."""
    n = len(words)
    equal = np.zeros(n + 1, np.int64)
    equal[1:n] = np.cumsum(words[1:] == words[:-1])
    equal[n] = equal[n - 1] if n else 0
    at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if n else np.zeros(0, np.int64)
    names = words[at]
    for level in range(levels):
        salt = U((level + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
        left = (mixed(names + salt) & U(1)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = left[:-1] & ~left[1:]
        second = np.zeros(len(names), bool)
        second[1:] = joins[:-1]
        following = np.append(names[1:], U(0)) if len(names) else names
        paired = mixed(names * U(0x9FB21C651E98DF25) + following)
        names = np.where(joins, paired, names)[~second]
        at = at[~second]
    mark = np.zeros(n, bool)
    mark[at] = True
    places = np.arange(n)
    low, high = np.maximum(places - REACH, 0), np.minimum(places + REACH, n) - 1
    mark |= equal[high + 1] - equal[low] > 0 if n else mark
    return np.flatnonzero(mark)


def place(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    marks = np.append(beginnings(words), len(words) + WINDOW)
    return marks[np.searchsorted(marks, starts + REACH)]


WORDS = Kind(window=WINDOW, parse=parse, place=place, near=-REACH, far=REACH, within=True)


def kept_words(judge: Judge):
    """(row, number of words, kept words as bytes) for each row of a chunk."""
    chunk = judge.chunk
    for i, j, places, gone in judge.covered():
        for row in range(i, j):
            a, b = places[row - i], places[row - i + 1]
            cut = gone[a:b]
            raw = chunk.data[chunk.offsets[row]:chunk.offsets[row + 1]].tobytes().split()
            yield row, raw, [w for w, g in zip(raw, cut) if not g] if cut.any() else raw


def digest(judge: Judge) -> pa.Table:
    n, kept, sha = [], [], []
    for _, raw, left in kept_words(judge):
        n.append(len(raw))
        kept.append(len(left))
        sha.append(hashlib.sha256(b" ".join(left)).hexdigest())
    n, kept = np.array(n, np.int64), np.array(kept, np.int64)
    return pa.table({"doc_id": judge.chunk.rows["doc_id"].cast(pa.int64()), "n_words": n, "n_removed": n - kept,
                     "kept_sha256": pa.array(sha, pa.string())})


def remove(docs: DataFrame) -> DataFrame:
    """docs with repeated words taken out of `text`; untouched texts stay as they are."""

    def finish(judge: Judge) -> pa.Table:
        rows = judge.chunk.rows
        old = rows["text"].to_pylist()
        new = [old[row] if len(left) == len(raw) else b" ".join(left).decode() for row, raw, left in kept_words(judge)]
        return rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    named = by_place(docs)
    return judged(named, WORDS, finish, named.schema).toDF(*docs.columns)


def op5_recompression(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, WORDS, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM w),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS h FROM places WHERE i + 19 <= len(words)),
marked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS seen FROM windows),
covered AS (
  SELECT p.doc_id, p.i, p.words[p.i] AS word,
    coalesce(p.i - max(CASE WHEN seen THEN p.i END) OVER (PARTITION BY p.doc_id ORDER BY p.i) < 20, false) AS gone
  FROM places p LEFT JOIN marked m ON m.doc_id = p.doc_id AND m.i = p.i),
summed AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN summed s ON s.doc_id = w.doc_id
"""
