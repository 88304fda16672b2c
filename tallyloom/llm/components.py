"""Connected components of a stored edge table: hook to the smallest neighbour, jump, contract.

Each step reads stored tables and joins plain exchanges, so Spark can split the rows of a hub; the
smallest neighbour is a map-side aggregate. Chains and stars shrink by half or more per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import discard, materialise


def _contracted(edges: DataFrame) -> DataFrame:
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return materialise(ordered.where(F.col("a") < F.col("b")).distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges(a, b)``: the smallest id that links reach.

    Repeated edges, both directions and loops may occur; nodes without an edge to another are absent.
    """
    edges = _contracted(edges)
    labels: DataFrame | None = None
    while not edges.isEmpty():
        old = [edges]
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("up")), "hooks")
        while True:
            below = hooks
            above = hooks.select(F.col("id").alias("up"), F.col("up").alias("top"))
            hooks = materialise(hooks.join(above, "up").select("id", F.col("top").alias("up"), (F.col("up") != F.col("top")).alias("moved")), "hooks")
            discard(below)
            if hooks.where("moved").isEmpty():
                break
        stored, hooks = hooks, hooks.select("id", "up")
        if labels is None:
            labels = hooks.withColumnRenamed("up", "component")
        else:
            old += [stored, labels]
            step = hooks.select(F.col("id").alias("component"), "up")
            labels = labels.join(step, "component", "left").select("id", F.coalesce("up", "component").alias("component"))
            labels = materialise(labels, "labels")
        left = hooks.select(F.col("id").alias("a"), F.col("up").alias("ua"))
        right = hooks.select(F.col("id").alias("b"), F.col("up").alias("ub"))
        edges = _contracted(edges.join(left, "a").join(right, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")))
        discard(*old)
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
