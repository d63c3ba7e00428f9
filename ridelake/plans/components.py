"""Connected components of a graph too large for one task.

Every round links each node to the least node next to it, seen from above and
from below, so the longest path shrinks geometrically and a chain of n nodes
takes O(log n) rounds of joins and aggregations, each written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialize import materialize


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its least reachable node) of every node of
    the undirected ``edges`` between long ids."""
    links = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
                        .where("v <> m").distinct(), "components")
    before = None
    while True:
        # nodes above u go to the least node next to u
        sides = links.select(F.col("m").alias("u"), F.col("v").alias("w")).unionByName(
            links.select(F.col("v").alias("u"), F.col("m").alias("w")))
        near = sides.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        down = sides.join(near, "u").where("w > u").select(F.col("w").alias("v"), "m").distinct()
        # a node's lower neighbours, and the node, go to the least of them
        least = down.groupBy("v").agg(F.min("m").alias("to"))
        both = down.join(least, "v")
        links = materialize(both.select("v", F.col("to").alias("m")).unionByName(
            both.select(F.col("m").alias("v"), F.col("to").alias("m"))).where("v <> m").distinct(), "components")
        now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
    return links.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(
        links.select(F.col("m").alias("node"), F.col("m").alias("component"))).distinct()
