"""Quality rules: exact counts of a text's form, and a calibrated linear model beside them.

The model is a logistic regression over hashed words, word pairs and byte runs, fitted on
labelled rows and calibrated on labelled rows that it has not seen (Platt's two numbers).
All texts are scored in Arrow batches; the threshold is fixed.

Defined cases: null and empty texts have no words, fail the base rules and are not kept;
rows with equal doc_id are judged one by one; without labels of both kinds the model accepts
every text and only the base rules hold; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.features import FIT_BYTES, Features, Model, descend, sigmoid
from chartfold.llm.grams import slices, texts
from chartfold.llm.sampling import texts_of
from chartfold.llm.text import table

SAMPLE_ROWS = 4000  # labelled rows to fit on, at most
STEPS = 60
RATE = 0.3
RIDGE = 1e-4
THRESHOLD = 0.3
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, score double, kept boolean")


def fit(data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> bytes:
    """Weights, then the slope and shift of the calibration, as the bytes of a vector."""
    parts = [(Features(d, o), label[i:j]) for i, j, d, o in slices(data, offsets, FIT_BYTES)]
    unseen = np.arange(len(label)) % 5 == 0
    seen, at = [], 0
    for features, y in parts:
        seen.append(~unseen[at:at + len(y)])
        at += len(y)
    n = max(1, sum(s.sum() for s in seen))

    def gradient(model: Model) -> np.ndarray:
        total = RIDGE * model.vector()
        for (features, y), s in zip(parts, seen):
            total += model.pull(features, (sigmoid(model.scores(features)) - y) * s / n)
        return total

    model = descend(gradient, STEPS, RATE)
    z = np.concatenate([model.scores(f) for f, _ in parts])[unseen]
    slope, shift = calibrate(z, label[unseen])
    return np.concatenate([model.vector(), [slope, shift]]).astype("<f8").tobytes()


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling by Newton steps, with his smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
    return float(max(w[0], 1e-3)), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, label) of at most `rows` labelled documents, chosen by hash of their id."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("label"))
    return texts_of(docs, known, rows, 10).select("draw", "text", "label")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes | None:
    """The fitted model; the bounded sample goes to one task, its weights to the driver."""

    def task(whole: pa.Table) -> pa.Table:
        order = np.argsort(whole["draw"].to_numpy(), kind="stable")
        whole = whole.take(pa.array(order))
        label = whole["label"].to_numpy()
        data, offsets = texts(whole["text"])
        model = fit(data, offsets, label) if 0 < label.sum() < len(label) else None
        return pa.table({"model": pa.array([model], pa.binary())})

    sample = labelled_sample(docs, labels, rows)
    made = sample.withColumn("whole", F.lit(0)).groupBy("whole").applyInArrow(task, "model binary").collect()
    return bytes(made[0][0]) if made and made[0][0] is not None else None


def judge(docs: DataFrame, model: bytes | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base verdict, calibrated score and final verdict of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.frombuffer(model, "<f8") if model else None
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            for i, j, d, o in slices(data, offsets):
                features = Features(d, o)
                c = features.counts
                if vector is None:
                    score = np.ones(j - i)
                else:
                    score = sigmoid(Model.of(vector[:-2]).scores(features) * vector[-2] + vector[-1])
                failed = (c.n_words < 10) | (100 * c.n_repeat_words > 20 * c.n_words)
                longs = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i).cast(pa.int64()),
                     *(pa.array(x.astype(np.int64)) for x in longs),
                     pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))

