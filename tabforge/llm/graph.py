"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.tables import settled


def _place(column: str) -> Column:
    return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("n"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the graph with links (a, b); a component is named by its least node.

    Each round every node follows its first neighbour in a random-looking but fixed order, and
    the links between what they followed go on. In such an order a constant share of the nodes
    goes each round, so long chains take few rounds too. Sums over neighbours combine before the
    shuffle, so a node with very many links is no hot group.
    """
    edges = settled(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(_place("b")).alias("near"))
        step = settled(first.select(F.col("a").alias("node"), F.least(_place("a"), F.col("near"))["n"].alias("root")))
        steps.append(step)
        left, right = step.toDF("a", "x"), step.toDF("b", "y")
        edges = settled(
            edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0]
    for step in steps[1:]:
        found = found.join(step.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    return settled(found.join(least, "root").select("node", "component"))
