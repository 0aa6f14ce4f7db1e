"""Distributed union-find: contract the graph along smallest neighbours until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """``(id, root)`` for every id in ``edges`` (columns ``a``, ``b``); root is one id of the component.

    Each round hooks every node to its smallest neighbour, follows the hooks a few steps and renames the
    edges. Every node that is not smaller than all its neighbours disappears, so a component of any shape
    at least halves per round. Rounds are written to the shared folder; hubs meet only in a partial
    aggregation and in joins that adaptive execution can split. Self-loops and null ends are dropped.
    """
    left = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("up"))
        for _ in range(jumps):
            above = hooks.select(F.col("id").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(above, "up").select("id", F.col("top").alias("up"))
        hooks = written(hooks, "hooks")
        maps.append(hooks)
        renamed = left
        for end in ("a", "b"):
            renamed = renamed.join(hooks.select(F.col("id").alias(end), "up"), end).drop(end).withColumnRenamed("up", end)
        left = written(renamed.where("a <> b").select("a", "b").distinct(), "edges")
    if not maps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = maps.pop()
    while maps:
        above = found.select(F.col("id").alias("up"), F.col("up").alias("top"))
        found = maps.pop().join(above, "up", "left").select("id", F.coalesce("top", "up").alias("up"))
    return found.select("id", F.col("up").alias("root"))
