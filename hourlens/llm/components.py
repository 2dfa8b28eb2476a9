"""Connected components of a graph of links, as rounds of joins.

Each round every node hooks on to its smallest neighbour, two pointer jumps flatten the chains,
and the links are rewritten between the new roots.  A node that is not the smallest around it
always moves, so roots at least halve; what is left of the links shrinks with them.  A hub is never
gathered: its minimum is pre-aggregated and joins on it are split by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlens.llm.common import Stages


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Loops and repeated links are allowed; no links give no rows."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stages.write(both.where("a <> b").distinct())
    roots = stages.write(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    while not edges.isEmpty():
        up = edges.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("old"), F.least("a", "b").alias("up"))
        first = up = stages.write(up)
        for _ in range(2):
            jump = up.select(F.col("old").alias("via"), F.col("up").alias("next"))
            up = up.join(jump, up["up"] == jump["via"], "left").select(
                "old", F.coalesce("next", "up").alias("up"))
        up = stages.write(up)
        moved = roots.join(up, roots["root"] == up["old"], "left").select(
            "node", F.coalesce("up", "root").alias("root"))
        left, right = (up.select(F.col("old").alias(f"old_{s}"), F.col("up").alias(f"up_{s}")) for s in "ab")
        rewritten = (edges.join(left, F.col("a") == F.col("old_a"))
                     .join(right, F.col("b") == F.col("old_b"))
                     .select(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
                     .where("a <> b").distinct())
        done = first, up, roots, edges
        roots, edges = stages.write(moved), stages.write(rewritten)
        stages.drop(*done)
    stages.drop(edges)
    return roots
