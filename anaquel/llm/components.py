"""Connected components of a graph of links, by contraction.

Each round every node takes the smallest of itself and its neighbours as parent, the parents are followed
to their roots by pointer jumping, and the links are rewritten between roots. Each step is a grouping
with combining before the shuffle or a join of two written tables, which adaptive execution splits
where one node has very many links. Rounds are logarithmic in the size of a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.sources.staging import stage


def _roots(parents: DataFrame) -> DataFrame:
    """``node``, ``parent`` with every parent followed to its root."""
    while True:
        above = parents.filter("parent != node").select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = stage(
            parents.join(above, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")),
            "parents",
        )
        parents = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return parents


def components(links: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links``."""
    pairs = links.select(F.col(source).alias("a"), F.col(target).alias("b")).filter("a != b")
    edges = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent"))
        roots = _roots(stage(parents, "parents"))
        if found is None:
            found = roots.select("node", F.col("parent").alias("component"))
        else:
            up = roots.select(F.col("node").alias("component"), "parent")
            found = stage(found.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component")), "components")
        left = roots.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = roots.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").filter("pa != pb")
        edges = stage(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return found
