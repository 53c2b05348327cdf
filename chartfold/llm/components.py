"""Connected components of an undirected graph, by contraction in a few Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.session import fresh_folder
from chartfold.storage import write_work_table


def _written(df: DataFrame) -> DataFrame:
    return write_work_table(df, fresh_folder(df.sparkSession, "components"))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each end of an edge (a, b): the least id that it reaches.

    A round hooks every vertex to its least smaller neighbour, follows these hooks to their
    ends by doubling, and goes on with the edges between the ends, of which there are fewer
    each time. A vertex with very many edges is summed before the shuffle.
    """
    edges = _written(_ordered(edges))
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component"))
    labels = _written(labels)
    while not edges.isEmpty():
        hooks = _written(edges.groupBy(F.col("b").alias("low")).agg(F.min("a").alias("to")))
        while True:
            up = hooks.select(F.col("low").alias("to"), F.col("to").alias("further"))
            jumped = _written(hooks.join(up, "to", "left").select(
                "low", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
            hooks = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        moved = hooks.select(F.col("low").alias("component"), "to")
        labels = _written(labels.join(moved, "component", "left").select(
            "id", F.coalesce("to", "component").alias("component")))
        for end in ("a", "b"):
            edges = edges.join(hooks.withColumnRenamed("low", end), end, "left").withColumn(
                end, F.coalesce("to", end)).drop("to")
        edges = _written(_ordered(edges))
    return labels
