"""Connected components of a link table, by alternating star contraction.

Every round is two joins on the whole link table; nothing is collected but a count and a
checksum. Each round is written to the shared folder, so that lineage stays short and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paceline.sources.scratch import written


def _with_least(pairs: DataFrame) -> DataFrame:
    """``pairs(u, v)`` with the least neighbour of u, u itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").withColumn("least", F.least("least", "u"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    own = starred.select("u", F.col("least").alias("v"))
    others = starred.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return own.union(others)


def connected_components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node that has a link to another one.

    ``component`` is the smallest node reachable. Links are undirected; repeated links, links
    of a node to itself and nulls change nothing; an empty table gives an empty one.
    """
    links = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct()
    links = written(links, "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == seen:
            break
        seen = state
        links = written(_small_star(_large_star(links)).where("u <> v").distinct(), "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
