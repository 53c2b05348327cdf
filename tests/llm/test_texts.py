"""Classifiers, decontamination and the pipeline."""

from __future__ import annotations

import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from chartfold.llm import decontamination, grams, pu_quality, quality_rules
from chartfold.llm.features import Features, Model

SF = "/root/testdata/sf0.01"


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams5 = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, g in enumerate(grams5) if grams5.count(g) > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_base_counts_equal_brute_force(spark, corpus, odd_texts):
    rows = [(d, t) for d, t in odd_texts if d != 20 and d != 21]
    rows += [(500, "a b\n a b\na b\n\n \na b \n"), (501, "#*$%&|<> ü€😀 x" * 3), (502, "one two three four five " * 4),
             (503, "\n".join(["same line here"] * 5)), (504, "tail\x0bwith\x0codd\x85breaks in it")]
    made = quality_rules.judge(corpus(rows), None).collect()
    expected = sorted(((d, *base_counts(t)) for d, t in rows), key=str)
    assert sorted((tuple(r)[:7] for r in made), key=str) == expected
    assert all(r.kept != r.base_failed for r in made)


def test_slices_do_not_change_features(monkeypatch, odd_texts):
    import pyarrow as pa
    data, offsets = grams.texts(pa.array([t for _, t in odd_texts]))
    model = Model.of(np.random.default_rng(1).normal(size=len(Model.blank().vector())))
    whole = model.scores(Features(data, offsets))
    parts = []
    monkeypatch.setattr(grams, "SLICE_BYTES", 500)
    for _, _, d, o in grams.slices(data, offsets):
        parts.append(model.scores(Features(d, o)))
    assert np.allclose(np.concatenate(parts), whole)


def test_rules_learn_labels(spark):
    made = quality_rules.op10_quality_rules(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = made.join(labels, "doc_id").collect()
    right = [r.kept == bool(r.quality) for r in rows if not r.base_failed]
    assert made.count() == 1000 and np.mean(right) > 0.97


def test_classifier_on_held_out_rows(spark):
    made = pu_quality.op3_pu_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [r for r in made.join(labels, "doc_id").collect() if r.held_out]
    assert all(crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98
    assert made.count() == 1000 and min(good) >= 0 and max(good) <= 1


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(6)
    positive = rng.normal(2, 1, 4000)
    for prior in (0.3, 0.6, 0.9):
        n = int(4000 * prior)
        unlabelled = np.concatenate([rng.normal(2, 1, n), rng.normal(-2, 1, 4000 - n)])
        assert abs(pu_quality.class_prior(positive, unlabelled) - prior) < 0.08


def test_held_out_labels_are_never_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    chosen = pu_quality.sample(docs, labels).select("text").distinct()
    out = docs.where(pu_quality.held_out("doc_id")).select("text").distinct()
    learned = docs.where(~pu_quality.held_out("doc_id")).select("text").distinct()
    assert chosen.join(out.subtract(learned), "text").count() == 0


def test_samples_are_bounded_whatever_one_id_holds(spark, monkeypatch):
    from chartfold.llm import sampling

    rows = [(7, f"hot row {i}") for i in range(1500)] + [(i, f"text {i} " * 20) for i in range(100, 400)]
    rows += [(8, None), (9, "long " * 300_000), (10, "twice"), (10, "twice"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in (7, 8, 9, 10, *range(100, 200))], "doc_id long, quality int, toxic int")
    assert quality_rules.labelled_sample(docs, labels, 60).count() in (59, 60)  # one of them may be too long
    marks = [r.positive for r in pu_quality.sample(docs, labels, 40).collect()]
    assert marks.count(True) <= 40 and marks.count(False) <= 40
    every = sampling.texts_of(docs, docs.select("doc_id").distinct(), 10_000, 1).collect()
    assert len(every) == 303 and "long" not in {(r.text or "")[:4] for r in every}
    monkeypatch.setattr(sampling, "SAMPLE_BYTES", 5000)
    few = sampling.texts_of(docs, docs.select("doc_id").distinct(), 10_000, 1).collect()
    assert 5 < len(few) < 60 and sum(len(r.text or "") for r in few) <= 5000


def test_odd_texts_are_scored(spark, corpus, odd_texts):
    labels = spark.createDataFrame([(d, int(d % 2)) for d, _ in odd_texts if d is not None], "doc_id long, quality int")
    docs = corpus(odd_texts)
    for model in (None, pu_quality.train(docs, labels)):
        rows = pu_quality.score(docs, model, "p").collect()
        assert len(rows) == len(odd_texts) and all(0 <= r.p <= 1 for r in rows) and rows[0].score == "x"
    assert quality_rules.judge(docs, quality_rules.train(docs, labels)).count() == len(odd_texts)
    for module in (pu_quality, quality_rules):
        assert module.train(docs, labels.limit(0)) is None and module.train(docs.limit(0), labels) is None


def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def least_distance(item, words):
    cost = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(words, 1):
            row.append(min(cost[j] + 1, row[-1] + 1, cost[j - 1] + (a != b)))
        cost = row
    return min(cost)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 30

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, prose(n)) for i, n in enumerate([1, 2, 3, 5, 8, 13, 15, 20, 33, 58, 13, 27])]
    docs = []
    for d in range(240):
        words = prose(rng.choice([0, 5, 40, 200]))
        item = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, 2 + len(item) // 4)):
            at = rng.randrange(len(item) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                item.insert(at, rng.choice(vocabulary))
            elif kind == 1 and item:
                item.pop(min(at, len(item) - 1))
            elif item:
                item[min(at, len(item) - 1)] = rng.choice(vocabulary)
        at = rng.randrange(len(words) + 1)
        docs.append((d, ", ".join(words[:at] + [w.upper() for w in item] + words[at:])))
    return [(i, " ".join(w)) for i, w in items] + [(90, None), (91, ""), (None, "x")], docs


@pytest.mark.parametrize("block", [20000, 4])
def test_passages_equal_brute_force(spark, corpus, planted, block, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEMS", block)
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (block,))
    listed, rows = planted
    rows = rows + [(300, None), (301, ""), (302, rows[9][1]), (302, rows[9][1]), (None, rows[9][1])]
    benchmark = spark.createDataFrame(listed, "item_id long, text string")
    made = decontamination.contaminated(corpus(rows), benchmark).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in made}
    expected = {}
    for d, t in rows:
        for i, item in listed:
            item = norm(item)
            if i is not None and item:
                e = least_distance(item, norm(t))
                if e <= int(0.2 * len(item) + 1e-9):
                    expected[d, i] = e
    assert set(found) <= set(expected)
    assert all(found[k] == expected[k] for k in found)
    assert len(found) >= 0.99 * len(expected)
    clean = decontamination.clean(corpus(rows), benchmark)
    dirty = {d for d, _ in found}
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - dirty
    assert sum(r.doc_id == 302 for r in made) in (0, 2 * sum(d == 302 for d, _ in found))


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.choice([0, 1, 1])] = rng.choice([[rng.choice(vocabulary)], [rng.choice(vocabulary)], []])
        words = words or [rng.choice(vocabulary)]
    return words


@pytest.mark.parametrize("n", [5, 15, 50, 100, 150])
def test_walks_keep_passages_at_the_limit_and_reject_other_words(n):
    rng = random.Random(n)
    vocabulary = [f"v{i}" for i in range(5000)]
    item = [rng.choice(vocabulary) for _ in range(n)]
    near = [edited(rng, item, n // 5, vocabulary) for _ in range(200)]
    far = [[rng.choice(vocabulary) for _ in range(n)] for _ in range(200)]
    items = decontamination.Items([1], *grams.texts(pa.array([" ".join(item)])))
    grams3 = [(item[a:a + 3] * n)[:n] for a in range(n - 2) for _ in range(200)][::n - 2]
    for windows, low, high in ((near, 198, 200), (far, 0, 2), (grams3, 0, 10 if n == 50 else 200)):
        words = decontamination.words_of(*grams.texts(pa.array([" ".join(w) for w in windows])))
        begin, end = words.first[:-1], words.first[1:]
        passed = decontamination.agree(words, items, np.zeros(200, np.int64), begin, np.minimum(end, begin + n))
        assert low <= passed.sum() <= high


def test_no_documents_and_no_items(spark, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(corpus([(1, "a b c")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.contaminated(corpus([]), some).count() == 0


def test_pipeline_stages_follow_their_operators(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf = "/root/testdata/sf0.001"
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, kept, sf).cache()
        assert left.columns == columns, name
        ids = {r.doc_id for r in left.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in kept.select("doc_id").collect()}
        kept = left
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert rows and all(set(r.doc_ids) <= ids for r in rows)


def test_pipeline_on_odd_rows(spark, corpus, odd_texts, tmp_path):
    docs = corpus(odd_texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "w1 w2")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
