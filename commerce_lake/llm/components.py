"""Connected components of a link table, as Spark jobs over slim rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round every node moves to the parent of its smallest neighbour, and
    links that do not lead to that neighbour are handed one step down, until
    only stars are left (a logarithmic number of rounds in practice).  Both
    sides of each join are stored tables, so a hub with a third of all links is
    split by the skew join.  Null nodes and self links are dropped; an empty
    table gives an empty result.
    """
    edges = scratch.store(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
        .distinct(), "edges")
    while True:
        parent = scratch.store(edges.groupBy("hi").agg(F.min("lo").alias("p")), "parent")
        grand = parent.select(F.col("hi").alias("p"), F.col("p").alias("g"))
        jumped = parent.join(grand, "p", "left").select(
            "hi", F.coalesce("g", "p").alias("lo"), F.col("g").isNotNull().alias("moved"))
        handed = (edges.join(parent, "hi").where(F.col("lo") != F.col("p"))
                  .select(F.col("lo").alias("hi"), F.col("p").alias("lo"), F.lit(True).alias("moved")))
        after = scratch.store(
            jumped.unionByName(handed).groupBy("hi", "lo").agg(F.max("moved").alias("moved")), "edges")
        done = not after.where("moved").take(1)
        scratch.drop(edges, parent)
        edges = after.select("hi", "lo")
        edges._scratch_path = after._scratch_path
        if done:
            break
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(roots.withColumn("component", F.col("node"))))
