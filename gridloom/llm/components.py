"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import release, staged


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of edges; component is the smallest node that links reach.

    Each round joins every node to the smallest of its neighbours, so rounds grow as the logarithm of the longest
    path; they go on until all components are stars. Smallest neighbours are found by sums before the shuffle, and written,
    so that the join of a hub's many links with its one smallest is one that Spark can split. Nothing but one row of
    sums comes to the driver. Edges with a null end, repeated ones and those from a node to itself are ignored; an empty
    table gives none.
    """
    live = edges.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")).where("u <> v").where(F.col(a).isNotNull() & F.col(b).isNotNull())
    live = staged(live.distinct(), "edges")
    while True:
        # large star: every neighbour above a node goes to the node's smallest; an edge's lower end is what it hangs on
        both = live.union(live.select("v", "u"))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "low")
        large = staged(live.join(low.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v")).distinct(), "large")
        # small star: what lies below a node goes to the smallest of it
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        done, live = live, staged(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        release(done, low, large, least)
        now = live.agg(F.count("*"), F.count_distinct("u")).first()
        if now[0] == now[1] and live.join(live.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break  # every node has one neighbour, and that one has none above it: stars
    return live.select(F.col("u").alias("node"), F.col("v").alias("component")).union(live.select("v", "v").distinct())


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that links (a, b) among n places reach from each: the same for the links of one task."""
    own = np.arange(n)
    while True:
        low = np.minimum(own[a], own[b])
        now = own.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == own).all():
            return own
        own = now
