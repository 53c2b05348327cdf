"""Quality classifier by positive-unlabelled learning.

Positives are trusted rows with label 1. The unlabelled rows are web text of which nothing
is known; a share of them, the class prior, is positive too. With that prior, the risk of a
scorer g over all text can be written without negatives,

    prior * R_p(+g)  +  max(0, R_u(-g) - prior * R_p(-g)),

where the second term, the risk on negatives, is kept from going below zero: once it does,
a step goes the other way on it. The prior is estimated first: a scorer of positives against
unlabelled rows is fitted on one half, and on the other half the least ratio of unlabelled to
positive rows above a score, over all scores, is the largest share of unlabelled text that
can look like positives.

Fitting sees at most SAMPLE_ROWS positives and as many unlabelled rows, chosen by hash of
their id among the rows that may be learned from; every document is scored whole.

Defined cases: null and empty texts get the score of a text without features; rows with equal
doc_id are scored one by one, null ids are scored and never learned from; without positives
every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartfold.llm.features import FIT_BYTES, Features, Model, descend, sigmoid
from chartfold.llm.grams import slices, texts
from chartfold.llm.sampling import texts_of
from chartfold.llm.text import free_name, table

SAMPLE_ROWS = 3000
STEPS = 60
RATE = 0.3
RIDGE = 1e-4
LEAST_SEEN = 0.2  # share of positives that must lie above a score for the prior's estimate
HIGHEST_PRIOR = 0.98


def held_out(doc_id: str | Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = LEAST_SEEN) -> float:
    """The least ratio of unlabelled to positive rows at or above a score."""
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 41))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    return float(np.clip((u / p).min(), 0.05, HIGHEST_PRIOR))


class Rows:
    """Features of the rows to fit on, slice by slice, with a mark for positives."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, positive: np.ndarray):
        self.parts = [(Features(d, o), positive[i:j], np.arange(i, j))
                      for i, j, d, o in slices(data, offsets, FIT_BYTES)]
        self.positive, self.n = positive, len(positive)

    def scores(self, model: Model) -> np.ndarray:
        return np.concatenate([model.scores(f) for f, _, _ in self.parts])

    def pull(self, model: Model, slope: np.ndarray) -> np.ndarray:
        return sum(model.pull(f, slope[at]) for f, _, at in self.parts) + RIDGE * penalised(model)


def penalised(model: Model) -> np.ndarray:
    v = model.vector()
    v[-1] = 0
    return v


def fit(rows: Rows, steps: int = STEPS) -> tuple[Model, float]:
    """The scorer of least non-negative risk, and the prior it was fitted with."""
    positive, unlabelled = rows.positive, ~rows.positive
    half = np.arange(rows.n) % 2 == 0

    def apart(model: Model) -> np.ndarray:
        weight = np.where(positive, 0.5 / max(1, (positive & half).sum()), 0.5 / max(1, (unlabelled & half).sum()))
        return rows.pull(model, (sigmoid(rows.scores(model)) - positive) * weight * half)

    z = rows.scores(descend(apart, steps // 2, RATE))
    prior = class_prior(z[positive & ~half], z[unlabelled & ~half])
    n_p, n_u = max(1, positive.sum()), max(1, unlabelled.sum())

    def gradient(model: Model) -> np.ndarray:
        z = rows.scores(model)
        p = sigmoid(z)
        lost = np.logaddexp(0, z)  # loss of calling a row negative
        on_negatives = lost[unlabelled].mean() - prior * lost[positive].mean()
        slope = np.where(positive, -prior * p / n_p, p / n_u)
        if on_negatives >= 0:
            slope = slope + np.where(positive, -prior * (1 - p) / n_p, 0)
        else:
            slope = -slope
        return rows.pull(model, slope)

    return descend(gradient, steps, RATE), prior


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(draw, text, positive): up to `rows` trusted positives and `rows` unlabelled documents."""
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id").distinct()
    trusted = labels.where("quality = 1").select("doc_id").distinct().join(ids, "doc_id")

    sides = ((trusted, 3, True), (ids, 33, False))
    made = [texts_of(docs, side.select("doc_id"), rows, seed).withColumn("positive", F.lit(mark)) for side, seed, mark in sides]
    return made[0].unionByName(made[1]).select("draw", "text", "positive")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes | None:
    """Weights and, last, the class prior. One task fits the bounded sample."""

    def task(whole: pa.Table) -> pa.Table:
        whole = whole.take(pa.array(np.argsort(whole["draw"].to_numpy(), kind="stable")))
        positive = whole["positive"].to_numpy(zero_copy_only=False).astype(bool)
        made = None
        if positive.sum() > 1 and (~positive).sum() > 1:
            model, prior = fit(Rows(*texts(whole["text"]), positive))
            made = np.append(model.vector(), prior).astype("<f8").tobytes()
        return pa.table({"model": pa.array([made], pa.binary())})

    made = sample(docs, labels, rows).withColumn("whole", F.lit(0)).groupBy("whole").applyInArrow(task, "model binary").collect()
    return bytes(made[0][0]) if made and made[0][0] is not None else None


def score(docs: DataFrame, model: bytes | None, name: str = "score") -> DataFrame:
    """docs with one more column, the probability that a text is of the positive kind."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model.of(np.frombuffer(model, "<f8")[:-1]) if model else None
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            found = [np.zeros(0)]
            for i, j, d, o in slices(data, offsets):
                found.append(sigmoid(scorer.scores(Features(d, o))) if scorer else np.full(j - i, 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found))],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(task, schema)


def accept(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier does not reject."""
    name = free_name("quality", docs.columns)
    kept = score(docs, train(docs, table(spark, sf_dir, "labels")), name).where(F.col(name) >= 0.5)
    return kept.select(*docs.columns)


def op3_pu_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
