"""Connected components by hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.session import cut_lineage

MAX_ROUNDS = 100


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, component)``, the component being its smallest node.

    The parallel scheme of Zhang, Azad and Hu (FastSV, 2020): each round a node
    looks at its neighbours' grandparents, hooks its parent and itself to the
    smallest, and points past its own parent, so the number of rounds grows
    with the logarithm of the longest chain. Everything a node collects from
    its neighbours is a minimum, combined before the shuffle; a node with a
    huge neighbourhood never gathers it.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.select("node", F.col("node").alias("parent")).distinct())
    for _ in range(MAX_ROUNDS):
        above = labels.select(F.col("node").alias("via"), F.col("parent").alias("grand"))
        known = labels.join(above, labels["parent"] == above["via"]).select("node", "parent", "grand")
        offers = (
            both.join(known.select(F.col("node").alias("b"), F.col("grand").alias("g")), "b")
            .groupBy("a")
            .agg(F.min("g").alias("offer"))
        )
        seen = known.join(offers, known["node"] == offers["a"], "left").select(
            "node", "parent", F.least("grand", F.coalesce("offer", "grand")).alias("best")
        )
        hooks = seen.groupBy(F.col("parent").alias("root")).agg(F.min("best").alias("hook"))
        moved = cut_lineage(
            seen.join(hooks, seen["node"] == hooks["root"], "left").select(
                "node",
                F.col("parent").alias("before"),
                F.least("best", "parent", F.coalesce("hook", "parent")).alias("parent"),
            )
        )
        labels = moved.select("node", "parent")
        if moved.filter("parent <> before").isEmpty():
            return labels.withColumnRenamed("parent", "component")
    raise RuntimeError("components did not settle")
