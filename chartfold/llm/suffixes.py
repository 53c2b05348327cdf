"""Suffix-array dedup: bytes that repeat a 50-byte string of an earlier document are removed.

The suffixes that are sorted are those at marked bytes: of the 24-byte tokens that begin in a
50-byte string, the one of least hash marks it, so equal strings are marked at the same byte
wherever they stand. A suffix begins with its marking token; its second token is all that the
strings marked there hold. Splitters sampled from tokens of the corpus cut the tokens' order
into ranges, each a bucket; buckets sort locally, key by key: by the first token, equal ones
by the second, equal ones by document. Neighbours with an equal first token are a repeat of
24 bytes at least; equal second tokens settle whole stretches at once, and what is left is
compared string by string across documents (see repeats.py for the passes). A splitter never
parts equal tokens, so no repeat lies across a boundary of buckets.

Defined cases: null and empty texts have no bytes; a row without id repeats nothing and is
repeated by nothing; rows of equal id do not match each other; an empty table gives an empty
result; other columns pass through `remove`, where bytes that are no whole character any more
are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.grams import BYTE_VALUES, U, texts, window_hash
from chartfold.llm.repeats import Judge, Kind, Records, by_place, even_splitters, judged, records
from chartfold.llm.text import table

WINDOW = 50
TOKEN = 24
SAMPLE_ROWS = 256  # documents whose tokens give the splitters


def parse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[data], offsets


def place(items: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The place of the token of least hash in each window; of equal ones the first."""
    n = len(items) - TOKEN + 1
    bits = max(1, int(n).bit_length())
    at = np.arange(n)
    keys = (window_hash(items, at, at + TOKEN) >> U(bits) << U(bits)) | at.astype(U)
    span, done = WINDOW - TOKEN + 1, 1
    while done < span:
        step = min(done, span - done)
        keys = np.minimum(keys[:-step], keys[step:])
        done += step
    return (keys[starts] & U((1 << bits) - 1)).astype(np.int64)


BYTES = Kind(window=WINDOW, parse=parse, place=place, near=0, far=TOKEN, within=False)


def sampled_splitters(docs: DataFrame):
    """Splitters from the tokens of SAMPLE_ROWS documents, chosen by hash of their id."""

    def tokens(batches):
        seen = set()
        for batch in batches:
            # One row of an id from each task, as an id may have any number of rows.
            ids = batch.column("doc_id").to_pylist()
            new = [i for i, x in enumerate(ids) if x not in seen and not seen.add(x)]
            data, offsets = texts(batch.column("text").take(pa.array(new, pa.int64())))
            found: Records = records(BYTES, *parse(data, offsets))
            yield pa.RecordBatch.from_arrays([pa.array(found.name[::16].astype(np.int64))], names=["token"])

    def splitters(ranges: int) -> np.ndarray:
        ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
        few = ids.orderBy(F.xxhash64(F.lit(8), "doc_id")).limit(SAMPLE_ROWS)
        chosen = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
        names = chosen.mapInArrow(tokens, "token long").toPandas()["token"].to_numpy().astype(U)
        if not len(names):
            return even_splitters(ranges)
        ordered = np.sort(names)
        return ordered[(np.arange(1, ranges) * len(ordered)) // ranges]

    return splitters


def digest(judge: Judge) -> pa.Table:
    chunk, rows = judge.chunk, []
    for i, j, places, gone in judge.covered():
        for row in range(i, j):
            cut = gone[places[row - i]:places[row - i + 1]]
            raw = chunk.data[chunk.offsets[row]:chunk.offsets[row + 1]]
            runs = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum()) if len(cut) else 0
            rows.append((len(raw), int(cut.sum()), runs, hashlib.sha256(raw[~cut].tobytes()).hexdigest()))
    n, removed, spans, sha = zip(*rows) if rows else ([], [], [], [])
    return pa.table({"doc_id": chunk.rows["doc_id"].cast(pa.int64()), "n_bytes": pa.array(n, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                     "kept_sha256": pa.array(sha, pa.string())})


def remove(docs: DataFrame) -> DataFrame:
    """docs with repeated bytes taken out of `text`."""

    def finish(judge: Judge) -> pa.Table:
        chunk = judge.chunk
        rows = chunk.rows
        new = rows["text"].to_pylist()
        for i, j, places, gone in judge.covered():
            for row in range(i, j):
                cut = gone[places[row - i]:places[row - i + 1]]
                if cut.any():
                    raw = chunk.data[chunk.offsets[row]:chunk.offsets[row + 1]]
                    new[row] = raw[~cut].tobytes().decode("utf-8", "ignore")
        return rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    named = by_place(docs)
    return judged(named, BYTES, finish, named.schema, sampled_splitters(docs)).toDF(*docs.columns)


def op8_suffix_array(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, BYTES, digest,
                  "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                  sampled_splitters(docs))


ORACLE = r"""
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, length(x) // 2 AS n FROM documents),
pieces AS (
  SELECT doc_id, n, p, substr(x, 2000 * p + 1, 2098) AS x
  FROM (SELECT doc_id, x, n, unnest(generate_series(0, n // 1000)) AS p FROM b)),
places AS (
  SELECT doc_id, 1000 * p + i AS i, substr(x, 2 * i - 1, 2) AS byte,
    CASE WHEN 1000 * p + i + 49 <= n THEN substr(x, 2 * i - 1, 100) END AS h
  FROM (SELECT *, unnest(generate_series(1, least(1000, n - 1000 * p))) AS i FROM pieces)),
marked AS (
  SELECT doc_id, i, byte, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS seen FROM places),
covered AS (
  SELECT doc_id, i, byte,
    coalesce(i - max(CASE WHEN seen THEN i END) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone
  FROM marked),
runs AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS first_one FROM covered),
summed AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE first_one) AS n_spans,
    string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM runs GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN summed s ON s.doc_id = b.doc_id
"""
