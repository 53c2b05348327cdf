from __future__ import annotations

import hashlib

import numpy as np
import pytest

from chartfold.llm import recompression, repeats, suffixes
from oracle import compare, connect


def words_left(rows):
    """Rows in order of (id, place in the list); windows seen in smaller ids or earlier in the row."""
    first, out = {}, {}
    cut = {i: (text or "").encode().split() for i, (_, text) in enumerate(rows)}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            for at in range(len(cut[i]) - 19):
                first.setdefault(tuple(cut[i][at:at + 20]), set()).add(doc)
    for i, (doc, _) in enumerate(rows):
        gone, seen = [False] * len(cut[i]), set()
        for at in range(len(cut[i]) - 19):
            w = tuple(cut[i][at:at + 20])
            if doc is not None and (min(first[w]) < doc or w in seen):
                gone[at:at + 20] = [True] * 20
            seen.add(w)
        kept = [x for x, g in zip(cut[i], gone) if not g]
        out.setdefault(doc, []).append((len(cut[i]), len(cut[i]) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return {d: sorted(v) for d, v in out.items()}


def bytes_left(rows):
    first, out = {}, {}
    for doc, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - 49):
            if doc is not None:
                first[raw[at:at + 50]] = min(doc, first.get(raw[at:at + 50], doc))
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if doc is not None and first[raw[at:at + 50]] < doc:
                gone[at:at + 50] = b"\1" * 50
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.setdefault(doc, []).append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return {d: sorted(v) for d, v in out.items()}


def collected(df):
    out = {}
    for row in df.collect():
        out.setdefault(row.doc_id, []).append(tuple(row)[1:])
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("chunk_rows", [3, 10_000])
def test_words_equal_brute_force(spark, corpus, odd_texts, chunk_rows, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_ROWS", chunk_rows)
    monkeypatch.setattr(repeats, "RANGE_ROWS", chunk_rows)
    docs = corpus(odd_texts)
    made = repeats.judged(docs, recompression.WORDS, recompression.digest,
                          "doc_id long, n_words long, n_removed long, kept_sha256 string")
    expected = words_left(odd_texts)
    assert collected(made) == expected
    assert sum(r[1] for rows in expected.values() for r in rows) > 500


@pytest.mark.parametrize("chunk_rows", [3, 10_000])
def test_bytes_equal_brute_force(spark, corpus, odd_texts, chunk_rows, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_ROWS", chunk_rows)
    monkeypatch.setattr(repeats, "RANGE_ROWS", chunk_rows)
    docs = corpus(odd_texts)
    made = repeats.judged(docs, suffixes.BYTES, suffixes.digest,
                          "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                          suffixes.sampled_splitters(docs))
    assert collected(made) == bytes_left(odd_texts)


def test_every_window_has_a_beginning_that_its_own_words_decide():
    rng = np.random.default_rng(1)
    for alphabet in (2, 3, 50):
        words = rng.integers(0, alphabet, 3000).astype(np.uint64)
        starts = np.arange(len(words) - 19)
        place = recompression.place(words, starts)
        assert (place >= starts + 4).all() and (place <= starts + 16).all()
        for s in rng.choice(starts, 200):
            assert recompression.place(words[s:s + 20], np.zeros(1, np.int64))[0] == place[s] - s


def test_place_of_a_window_that_begins_with_a_doubled_word_ignores_the_word_before():
    rng = np.random.default_rng(4)
    windows = rng.integers(0, 1 << 63, (12_000, 20)).astype(np.uint64)
    windows[:, 1] = windows[:, 0]
    start = np.zeros(1, np.int64)
    for window in windows:
        alone = recompression.place(window, start)[0]
        for before in rng.integers(0, 1 << 63, 2).astype(np.uint64):
            assert recompression.place(np.append(before, window), start + 1)[0] - 1 == alone


def test_marked_byte_depends_on_the_string_alone():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 2000).astype(np.uint8)
    items, _ = suffixes.parse(data, np.array([0, len(data)]))
    starts = np.arange(len(data) - 49)
    place = suffixes.place(items, starts)
    for s in rng.choice(starts, 200):
        assert suffixes.place(items[s:s + 50], np.zeros(1, np.int64))[0] == place[s] - s


def test_other_columns_pass_and_texts_lose_their_repeats(spark, corpus, odd_texts):
    docs = corpus(odd_texts)
    for module in (recompression, suffixes):
        left = module.remove(docs)
        assert left.columns == docs.columns and left.count() == docs.count()
        by_id = {r.doc_id: r for r in left.where("doc_id IN (11, 14, 15)").collect()}
        assert by_id[11].text == dict(odd_texts)[11] and by_id[11].chunk == "c"
    assert by_id[14].text == "x" * 300 and by_id[15].text == "y"


def test_rows_without_id_and_of_one_id_are_dealt_out(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_ROWS", 20)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(map(str, rng.integers(0, 1000, 30)))) for i in [None] * 100 + [7] * 100 + list(range(100, 200))]
    rows += [(300 + i, rows[90 + i][1]) for i in range(20)] + [(7, "copy " * 30)] * 100
    docs = corpus(rows).repartition(8)
    largest = spark.sparkContext.accumulator(0)

    def digest(judge):
        largest.add(len(judge.chunk.ids) ** 4)
        return recompression.digest(judge)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    made = repeats.judged(docs, recompression.WORDS, digest, schema).collect()
    assert len(made) == len(rows)
    expected = words_left(rows)
    out = {}
    for row in made:
        out.setdefault(row.doc_id, []).append(tuple(row)[1:])
    assert {d: sorted(v) for d, v in out.items()} == expected
    # One chunk of all rows of an id or of none has 200 rows or 100, and adds that to the power of 4.
    assert largest.value < 90 ** 4
    few = suffixes.sampled_splitters(corpus([(None, "x" * 99)] * 300 + rows))(8)
    assert len(set(few.tolist())) == 7


def test_words_and_bytes_equal_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(recompression.op5_recompression(spark, sf), recompression.ORACLE, connect(sf)) == 200
    assert compare(suffixes.op8_suffix_array(spark, sf), suffixes.ORACLE, connect(sf)) == 200


def test_empty_table(spark, corpus):
    for module in (recompression, suffixes):
        assert module.remove(corpus([])).count() == 0


@pytest.mark.parametrize("module", [recompression, suffixes])
def test_columns_may_have_any_names(spark, module):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, passage, 5, "a", "b"), (2, f"new {passage}", 6, "c", "d"), (None, passage, 7, "e", "f")],
                                 "doc_id long, text string, __chunk int, __SIZE string, _1 string")
    left = module.remove(docs)
    assert left.columns == docs.columns
    rows = {r["__chunk"]: (r["__SIZE"], r["_1"], r.text) for r in left.collect()}
    assert rows[5] == ("a", "b", passage) and rows[7] == ("e", "f", passage)
    assert rows[6][:2] == ("c", "d") and rows[6][2].strip() == "new"
