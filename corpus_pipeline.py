"""A training corpus from `documents`, stage by stage; every stage's rows are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartfold.llm import decontamination, near_duplicates, pu_quality, suffixes
from chartfold.llm.mixing import mix, mixed_rows
from chartfold.llm.text import table
from chartfold.session import fresh_folder
from chartfold.storage import write_work_table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pu_quality.accept(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.remove(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(mix(docs)[0])


STAGES = [
    ("quality classifier", accept_quality),
    ("near-duplicates", drop_near_duplicates),
    ("suffix array", cut_repeats),
    ("decontamination", drop_benchmark),
    ("mix sources", mix_sources),
]

# A fitted model decides on documents and hashes choose blocks: SQL cannot say which.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last gives the mixed blocks with the ids of their documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = write_work_table(stage(spark, docs, sf_dir), fresh_folder(spark, "stage"))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
