from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chartfold.llm import mixing


def shared(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by handing the excess of sources that stop to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {s: 0.0 for s in order}, share * sum(sizes.values()), set(order)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += give[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "é": 500, None: 7}, {"x": 1}, {"a": 0, "b": 5},
                                   {f"s{i}": 7 * i * i for i in range(30)}])
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = [(str(k), k, v) for k, v in sizes.items()]
    made = mixing.targets(spark.createDataFrame(rows, "key string, source string, source_size long")).collect()
    expected = shared(sizes)
    assert {r.source: pytest.approx(r.target) for r in made} == expected


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_places_are_permuted(spark, n):
    df = spark.range(n).withColumns({"n": F.lit(n).cast("long"), "key": F.lit("k"), "epoch": F.lit(0)})
    places = [r.id for r in mixing.shuffled(df, "id", "n", ["key", "epoch"]).collect()]
    assert sorted(places) == list(range(n))
    assert n < 17 or places != sorted(places)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(rng.randrange(1, 300))), rng.choice(["hot"] * 4 + ["b", "c", None]))
            for i in range(150)]
    return rows + [(150, None, "b"), (151, " \n", None), (None, "no id here", "b"), (3, "the same id", "c"),
                   (4, rows[4][1], rows[4][2]), (152, "long " * 20000, "hot")]


def test_mix_meets_its_targets(spark, corpus, documents):
    mixed, placed = mixing.mix(corpus(documents), block_words=8, shard_slots=64)
    rows = mixing.mixed_rows(mixed).collect()
    own = placed.collect()
    assert len(own) == len(documents)
    assert sum(r["size"] for r in own) == sum(len((t or "").split()) for _, t, _ in documents)
    for source in {r.source for r in own}:
        taken = sum(r.n_words for r in rows if r.source == source)
        target = next(r.target for r in own if r.source == source)
        assert abs(taken - target) <= 4
    seen = {}
    for r in rows:
        assert len(r.text.split()) == r.n_words <= 8
        seen[r.source, r.block] = seen.get((r.source, r.block), 0) + 1
    assert max(seen.values()) <= 2
    places = sorted((r.shard, r.position) for r in rows)
    assert len(set(places)) == len(places) and len({s for s, _ in places}) > 3


def test_small_targets_are_met(spark, corpus):
    rng = random.Random(8)
    rows = [(i, "w " * n, f"s{i:02d}") for i, n in enumerate([*range(1, 40), 66, 100, 129, 300, 777, 1000, 5000])]
    rows += [(100 + i, "w " * rng.randrange(1, 30), f"t{i % 7}") for i in range(200)]
    mixed, placed = mixing.mix(corpus(rows))
    taken = {r.source: r.words for r in mixed.groupBy("source").agg(F.sum("n_words").alias("words")).collect()}
    for r in placed.select("source", "source_size", "target").distinct().collect():
        block = max(1, min(64, r.source_size // 32))
        assert abs(taken.get(r.source, 0) - r.target) <= block / 2 + 1e-6, r


def test_taken_equals_a_mix_made_block_by_block(spark, corpus, documents, tmp_path):
    corpus(documents).write.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for r in mixing.op1_mix_sources(spark, str(tmp_path)).collect():
        found.setdefault((r.source, r.doc_id, r["size"]), []).append(r.taken)
    mixed, placed = mixing.mix(corpus(documents), with_text=False)
    place = placed.where("size > 0").orderBy("source", "start").collect()
    streams, blocks = {}, {}
    for n, r in enumerate(place):  # every word of a source by the row that it belongs to
        stream = streams.setdefault(r.source, [])
        assert r.start == len(stream)
        stream += [n] * r["size"]
    taken = [0] * len(place)
    for r in mixed.collect():
        stream = streams[r.source]
        length = max(1, min(64, len(stream) // 32))
        words = stream[r.block * length:(r.block + 1) * length]
        assert len(words) == r.n_words
        blocks.setdefault((r.source, r.epoch), []).append(r.block)
        for n in words:
            taken[n] += 1
    for (source, epoch), used in blocks.items():
        n = -(-len(streams[source]) // max(1, min(64, len(streams[source]) // 32)))
        assert len(set(used)) == len(used) and ((source, epoch + 1) not in blocks or len(used) == n)
    want = {}
    for n, r in enumerate(place):
        want.setdefault((r.source, r.doc_id, r["size"]), []).append(taken[n])
    assert {k: sorted(v) for k, v in found.items() if k[2]} == {k: sorted(v) for k, v in want.items()}
    assert all(v == [0] * len(v) for k, v in found.items() if not k[2])


def test_rows_without_id_spread_over_buckets(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(None, f"text {i}", "s") for i in range(1000)] + [(i, f"other {i}", "s") for i in range(1000)]
    seen = []
    placed = mixing._placed
    monkeypatch.setattr(mixing, "_placed", lambda rows, *a: seen.append(rows) or placed(rows, *a))
    _, own = mixing.mix(corpus(rows), with_text=False)
    assert own.count() == 2000
    assert seen[0].groupBy("key", "bucket").count().agg(F.max("count")).first()[0] < 150


def test_blocks_hold_the_words_of_their_documents(spark, corpus, documents):
    mixed, _ = mixing.mix(corpus(documents), block_words=8)
    text = {}
    for doc, t, _ in documents:
        text.setdefault(doc, []).append((t or "").split())
    for r in mixed.collect():
        words, at = r.text.split(), 0
        for p in r.pieces:
            assert any(" ".join(words[at:at + p.n]) in " ".join(t) for t in text[p.doc_id])
            at += p.n
        assert at == r.n_words


def test_reruns_agree_and_no_document_exceeds_twice_its_size(spark, corpus, documents, tmp_path):
    corpus(documents).write.parquet(f"{tmp_path}/documents.parquet")
    first, second = (sorted(map(tuple, mixing.op1_mix_sources(spark, str(tmp_path)).collect()), key=str) for _ in range(2))
    assert first == second and len(first) == len(documents)
    assert all(taken <= 2 * size for _, _, size, _, _, taken in first)


def test_empty_table(spark, corpus):
    mixed, placed = mixing.mix(corpus([]))
    assert mixed.count() == 0 and placed.count() == 0
    mixed, placed = mixing.mix(corpus([(1, None), (2, "")]))
    assert mixed.count() == 0 and [r.target for r in placed.collect()] == [0.0, 0.0]
