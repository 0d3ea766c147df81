"""Connected components of a table of links, by contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callspark.llm.common import written


def roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest given as (node, parent) with parent < node, by pointer jumping.

    Every round halves the depth, and the table is written after each.
    """
    current = written(parents.select("node", F.col("parent").alias("root")), "parents")
    while True:
        upper = current.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = written(
            current.join(upper, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "parents",
        )
        current = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return current


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of links (a, b); the root of a component is one of its nodes.

    In each round every node hangs itself below its least neighbour if that is less than itself;
    the trees are flattened, and links between different trees make the next, smaller round.
    """
    edges = written(links.select("a", "b").filter("a != b").distinct(), "links")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        flat = roots(least.filter("parent < node"))
        top = flat.select(F.col("node").alias("root"), F.col("root").alias("next"))
        if found is None:
            found = flat
        else:
            older = found.join(top, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            newer = flat.join(older.select("node"), "node", "left_anti")
            found = written(older.unionByName(newer), "components")
        left = flat.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = flat.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(
            edges.join(left, "a", "left").join(right, "b", "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
            .filter("a != b").distinct(),
            "links",
        )
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return found
