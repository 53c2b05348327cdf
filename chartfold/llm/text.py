"""Words, native: column expressions shared by the operators that stay on the JVM."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = "\t\n\x0b\f\r"


def space_words(text: str | Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    spaced = functools.reduce(lambda c, b: F.replace(c, F.lit(b), F.lit(" ")), BREAKS, text)
    return F.array_remove(F.split(spaced, " "), "")


def lower_ascii(text: str | Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def name_words(text: str | Column) -> Column:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text after lower-casing A-Z."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    cut = F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(cut, "")


def free_name(stem: str, columns: list[str]) -> str:
    """A column name that none of the columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def spread(df, *columns: str):
    """Deals rows out by columns to as many partitions as a shuffle has, however small they
    are now, because each of them will become many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
