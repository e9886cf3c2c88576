"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.staging import Staged


def components(links: DataFrame, staged: Staged, name: str) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node that it reaches.

    Each round hooks every node to its smallest neighbour, follows the hooks
    twice, and contracts the links to what is left between roots. At most the
    local minima remain, so a round at least halves the nodes of a component. A
    node with many links is one row per task after the partial minimum.
    """
    # Rows are (node, root): where a node of the round before has gone.
    ways = []
    edges = staged.write(links.select("a", "b").where("a <> b").distinct(), f"{name}-edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = staged.write(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("node"), F.col("to").alias("root")), f"{name}-hooks")
        once = _followed(hooked, hooked)
        way = staged.write(_followed(once, once), f"{name}-way{len(ways)}")
        staged.drop(f"{name}-hooks")
        ways.append(way)
        moved = edges.join(way.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(way.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        rest = staged.write(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-rest{len(ways)}")
        staged.drop(f"{name}-edges" if len(ways) == 1 else f"{name}-rest{len(ways) - 1}")
        edges = rest
    if not ways:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = ways[0]
    for way in ways[1:]:
        roots = _followed(roots, way)
    return staged.write(roots, f"{name}-roots")


def _followed(first: DataFrame, then: DataFrame) -> DataFrame:
    """Each node's root, moved on to where ``then`` sends it."""
    onward = then.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return first.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
