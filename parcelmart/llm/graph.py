"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import written


def _smallest(edges: DataFrame, key: str, value: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min(value).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b: long); a component is named by its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest neighbour, then its smaller ones. Each step keeps the components and shortens paths,
    so the number of rounds grows with the logarithm of the longest path. Only sums and minima by
    node are shuffled, and no node's neighbours are gathered.
    """
    # an edge points from the larger node to the smaller one
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = written(links, "links"), None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both, "u", "v").select("u", F.least("u", "least").alias("least"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct()
        large = written(large, "links")
        least = _smallest(large, "u", "v")
        handed = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = handed.unionByName(least.select("u", F.col("least").alias("v"))).filter("u <> v").distinct()
        links = written(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())
