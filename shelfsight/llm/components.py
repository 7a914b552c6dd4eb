"""Connected components of a distributed edge list, by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.session import written


def _to_roots(step: DataFrame) -> DataFrame:
    """``(node, to)`` with every pointer followed to its root; the distance halves with each pass."""
    while True:
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = written(
            step.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to"), (F.col("next") != F.col("to")).alias("moved")),
            "step",
        )
        step = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            return step


def connected_components(edges: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """``(node, component)`` for every node that an edge touches; the component is its smallest node.

    Each round points every node at its smallest neighbour (itself included), follows the pointers to their
    roots, replaces both ends of each edge by their roots, and drops loops and repeats. At least half of the
    nodes go in each round. The driver only learns whether edges are left. A hub costs one row per task in the
    minimum; the sides of each join are written tables, so adaptive execution can split a hub there.
    Null ends and loops are left out, repeated edges do no harm, and an empty edge list gives an empty result.
    """
    left = written(
        edges.select(F.least(low, high).alias("a"), F.greatest(low, high).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct(),
        "edges",
    )
    labels = left.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    first = True
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = _to_roots(written(nearest.select("node", F.least("node", "b").alias("to")), "step"))
        if first:
            labels, first = step.withColumnRenamed("to", "component"), False
        else:
            moved = step.withColumnRenamed("node", "component")
            labels = written(
                labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels"
            )
        ends = left.join(step.toDF("a", "a_to"), "a").join(step.toDF("b", "b_to"), "b")
        left = written(
            ends.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).where("a <> b").distinct(), "edges"
        )
    return labels
