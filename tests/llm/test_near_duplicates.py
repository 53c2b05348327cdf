from __future__ import annotations

import random

import numpy as np

from chartfold.llm import near_duplicates as near
from chartfold.llm.components import components
from oracle import compare, connect


def brute(rows, k, percent):
    sets, parent = {}, {}
    for doc, text in rows:
        words = (text or "").encode().translate(near.LOWER).split()
        found = {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
        if doc is not None:
            sets.setdefault(doc, []).append(found)
            parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def families(rng):
    """Copies and near copies, chains whose ends are far apart, and lone texts."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for f in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([8, 40, 200]))]
        for c in range(9):
            rows.append((len(rows), " ".join(base) if c % 3 else " ".join(base).upper()))
            at = rng.randrange(len(base))
            base = base[:at] + [rng.choice(words)] + base[at + 1:]
    return rows


def test_components_equal_brute_force(spark, corpus, odd_texts):
    rng = random.Random(5)
    rows = odd_texts + [(1000 + d, t) for d, t in families(rng)]
    rng.shuffle(rows)
    for k, percent in ((3, 85), (5, 80)):
        made = near.near_duplicates(corpus(rows), k, percent).collect()
        expected = brute(rows, k, percent)
        assert len(made) == len(rows)
        assert {r.doc_id: r.component_id for r in made if r.doc_id is not None} == expected
        assert all(r.kept == (r.doc_id == r.component_id) for r in made if r.doc_id is not None)
        assert all(r.component_id is None and r.kept for r in made if r.doc_id is None)


def test_tiles_find_what_stars_miss(spark, corpus, monkeypatch):
    monkeypatch.setattr(near, "TILE", 4)
    rows = families(random.Random(8))
    made = {r.doc_id: r.component_id for r in near.near_duplicates(corpus(rows), 3, 85).collect()}
    assert made == brute(rows, 3, 85)


def test_few_strays_cost_one_sending_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(near, "TILE", 8)
    copies, strays = range(1, 801), range(1000, 1003)
    buckets = spark.createDataFrame([(7, d, 1) for d in (*copies, *strays)], "band long, doc_id long, least long")
    parts = spark.createDataFrame([(d, 1) for d in copies], "id long, component long")
    rows = near.tiled(buckets, parts).collect()
    assert len(rows) == 800 + 3 * 101
    met = {}
    for r in rows:
        met.setdefault((r.low, r.high), []).append(r)
    pairs = [(min(a.doc_id, b.doc_id), max(a.doc_id, b.doc_id)) for m in met.values() for a in m for b in m
             if a.own == a.low and b.own == b.high and a.component != b.component and (a.low < a.high or a.doc_id < b.doc_id)]
    assert len(pairs) == len(set(pairs)) == 3 * 800 + 3


def test_bands_follow_the_threshold():
    for threshold, bands in ((0.85, 18), (0.8, 25)):
        assert near.bands_for(threshold) == bands and (1 - threshold ** near.ROWS) ** bands < 5e-5


def test_sizes_of_sets(spark, corpus):
    made = near.near_duplicates(corpus([(1, "a b a b a"), (2, "A b"), (3, None), (4, "")]), 3, 85).collect()
    assert {r.doc_id: r.n_shingles for r in made} == {1: 2, 2: 1, 3: 0, 4: 0}


def test_sequential_test_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    least = near.least_matches(0.85)
    equal = rng.random((20000, near.HASHES)) < 0.85
    right = np.ones((20000, near.HASHES), np.uint32)
    kept, _ = near.survivors(equal.astype(np.uint32), right, least)
    far, _ = near.survivors((rng.random((20000, near.HASHES)) < 0.3).astype(np.uint32), right, least)
    assert len(kept) > 0.999 * 20000 and len(far) == 0


def test_stage_keeps_one_of_each(spark, corpus):
    docs = corpus([(3, "some text here"), (1, "Some text here"), (2, "quite another one"), (None, "some text here")])
    left = near.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 2, None]


def test_empty_table(spark, corpus):
    assert near.near_duplicates(corpus([])).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(130, 99), (7, 7)]
    made = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(made[i] == 0 for i in range(61)) and all(made[100 + i] == 100 for i in range(30))
    assert made[130] == made[99] == 99


def test_op7_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(near.op7_minhash_bayes(spark, sf), near.ORACLE, connect(sf)) == 200
