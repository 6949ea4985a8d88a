"""Connected components of a link table by alternating star steps.

Links are rows (u, v). Each round is two grouped minima with a join each, over the
links only; links are written to the shared folder between rounds, so a lost
executor costs one round. A node with very many links is reduced map-side by the
minimum, and its join is left to Spark, which splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of u on one side of it are linked to the least node around u."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("least"))
    joined = both.join(least, both["u"] == least["node"])
    moved = joined.where("v > u" if large else "v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    if not large:
        moved = moved.union(least.select(F.col("node").alias("u"), F.col("least").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links; root is the least node of its component."""
    links = cut(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while True:
        links = cut(_star(_star(links, True), False), "links")
        state = links.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                                   F.lit(0)).alias("s")).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
