"""Connected components of links between rows, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.storage import store


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component``: each node of ``links`` and the smallest node it can reach.

    Nodes are values of any type that has an order. In every round each node is merged into the first node around it, in an order by
    hash, and that one into its own first; only links between different merged nodes go on to the next round, each once.
    So links and nodes shrink by a factor from round to round, whatever the shape, and all rounds together hold a few times the rows of the
    first. Each round is written to the shared folder.
    """
    edges = links.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    merges: list[DataFrame] = []
    while True:
        edges = store(edges.where("a != b").distinct(), "links")
        if edges.isEmpty():
            break
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = around.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("rank"), F.col("b").alias("into"))).alias("near"))
        own = F.struct(F.xxhash64("a").alias("rank"), F.col("a").alias("into"))
        first = store(first.select(F.col("a").alias("node"), F.least(own, "near")["into"].alias("into")), "first")
        further = first.select(F.col("node").alias("into"), F.col("into").alias("further"))
        merged = store(first.join(further, "into").select("node", F.col("further").alias("into")), "merged")
        merges.append(merged)
        ends = {x: merged.select(F.col("node").alias(x), F.col("into").alias(f"{x}_into")) for x in "ab"}
        edges = edges.join(ends["a"], "a").join(ends["b"], "b")
        edges = edges.select(F.least("a_into", "b_into").alias("a"), F.greatest("a_into", "b_into").alias("b"))
    if not merges:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # from the last and smallest round to the first
    roots = merges.pop().select("node", F.col("into").alias("root"))
    while merges:
        later = roots.select(F.col("node").alias("into"), "root")
        roots = merges.pop().join(later, "into", "left").select("node", F.coalesce("root", "into").alias("root"))
    roots = store(roots, "roots")
    return roots.join(roots.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")
