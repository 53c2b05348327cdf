"""Hard negatives against plain Python, over odd vectors."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from chartfold.llm import hard_negatives
from chartfold.llm.hard_negatives import Bucket

SCHEMA = "vec_id long, embedding array<float>, label int, score string, bucket int, block int, length double, row int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def odd_rows() -> list[tuple]:
    rng = random.Random(11)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]

    def near(c, spread, size=1.0):
        v = [x + rng.gauss(0, spread) for x in centre[c]]
        norm = math.sqrt(sum(x * x for x in v))
        return [size * x / norm for x in v]

    rows = [(i, near(i % 4, 0.15, rng.choice([0.3, 1.0, 1.0, 2.0])), rng.randrange(3)) for i in range(420)]
    same = near(0, 0.1)
    rows += [(1000 + i, same, i % 2) for i in range(60)]  # copies that tie in all but their ids
    rows += [(100, near(1, 0.1), 2), (500, same, 1), (500, same, 1), (600, same, 1)]  # equal ids, equal rows
    rows += [(700, None, 1), (800, [1.0, None], 1), (900, [float("nan")], 0), (901, [float("inf"), 0.0], 0)]
    rows += [(902, same, None), (None, same, 1), (None, same, 0), (1100, [], 1), (1200, [0.0] * 8, 1)]
    rows += [(1300, same[:3], 0), (1400, [-x for x in same], 2), (1500, [1e30, 0.0], 5), (1501, [1e30, 0.0], 5), (1600, same, 9)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3.0, 4) for r in rows], SCHEMA)


def brute(rows) -> list[tuple]:
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        ints = [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in v]
        kept.append((vec_id, label, ints + [0] * (8 - len(ints))))
    vectors = np.array([k[2] for k in kept], object)
    last = float("inf")
    found = []
    for i, (vec_id, label, v) in enumerate(kept):
        if vec_id is None or vec_id % 100:
            continue
        scores = [int(x) for x in vectors @ np.array(v, object)]
        order = sorted(range(len(kept)), key=lambda j: (-scores[j], last if kept[j][0] is None else kept[j][0]))
        for p in [j for j in order if j != i and kept[j][1] == label][:5]:
            fit = [j for j in order if kept[j][1] != label and 80 * scores[p] <= 100 * scores[j] <= 100 * scores[p]]
            found += [(vec_id, kept[p][0], r, kept[j][0], scores[p], scores[j]) for r, j in enumerate(fit[:5], 1)]
    return sorted(found, key=str)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*COLUMNS[:2], "rank", *COLUMNS[3:]).collect()), key=str)


@pytest.mark.parametrize(("bucket_rows", "block_anchors"), [(16_384, 8_192), (60, 3), (7, 1)])
def test_equals_brute_force(spark, bucket_rows, block_anchors):
    found = hard_negatives.hard_negatives(frame(spark, odd_rows()), bucket_rows=bucket_rows, block_anchors=block_anchors)
    assert rows_of(found) == brute(odd_rows())


def test_sql_says_the_same(spark):
    rows = [r for r in odd_rows() if r[1] is not None and len(r[1]) == 8]
    with duckdb.connect() as db:
        db.register("embeddings", frame(spark, rows).toArrow())
        found = db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({hard_negatives.ORACLE})").fetchall()
    assert sorted(found, key=str) == brute(rows)


def test_nothing_to_mine(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert hard_negatives.op11_hard_negatives(spark, str(tmp_path)).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(100, [1.0], 1)])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(3, [1.0], 1), (4, [1.0], 2)])).count() == 0


def test_ranges_hold_all_that_reach_the_score():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(5, 12))
    vectors = (base[rng.integers(0, 5, 900)] + rng.normal(size=(900, 12)) * 0.2) * rng.choice([20, 60, 61], (900, 1))
    vectors = np.rint(vectors).astype(np.int64)
    rows = pa.table({"row": pa.array(range(900)), "vec_id": pa.array(range(900)), "label": pa.array([0] * 900),
                     "vector": pa.array(vectors.tolist(), pa.list_(pa.int32()))})
    bucket = Bucket(rows, 12)
    pruned = 0
    for q in vectors[:60]:
        scores = vectors @ q
        for share in (0.3, 0.9, 0.99, 1.0, 1.2):
            least = share * float(scores.max())
            found = bucket.candidates(q, least)
            if found is not None:
                assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
                pruned += len(found) < 450
    assert pruned >= 60
