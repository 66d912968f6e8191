"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; a component's id is its smallest node.

    Rounds of two steps: every node hands its larger neighbours its smallest one,
    then every node hands its smaller neighbours the smallest of them. Links
    become stars in about log of the longest path rounds; no group is gathered,
    each round is stored.
    """
    edges = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(roots, "u")
        edges = materialise(
            small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(roots.select("u", F.col("low").alias("v"))).where("u <> v").distinct(), "links")
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (row["n"], row["h"]):
            break
        mark = (row["n"], row["h"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
