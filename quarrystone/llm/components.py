"""Connected components over an edge table, by alternating large-star and small-star rounds.

Each round is two aggregations with map-side combining and two joins between written tables, so a hub that touches a
third of all nodes is pre-aggregated in the one and split by adaptive execution in the other. Nothing but three numbers a
round reaches the driver. Published as "Connected Components in MapReduce and Beyond" (Kiveris et al., 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import scratch

ROUNDS = 64


def _state(edges: DataFrame) -> tuple[int, ...]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).first()
    return int(row.n), int(row.h or 0), int(row.s or 0)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest id reachable from each node that has an edge to another.

    ``edges`` holds two integer columns in either direction; loops and repeats are allowed and nulls are ignored. An empty
    table gives an empty result. Nodes absent from ``edges`` are absent from the result.
    """
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    edges = scratch.keep(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _state(edges)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        # large-star: every larger neighbour of a node is tied to the smallest id around that node
        least = scratch.keep(edges.groupBy("v").agg(F.min("v").alias("own")).unionByName(edges.groupBy("u").agg(F.min("v").alias("own")).withColumnRenamed("u", "v")).groupBy("v").agg(F.min("own").alias("least")), "large-least")
        large = scratch.keep(edges.join(least, "v").select("u", F.col("least").alias("v")).distinct(), "large")
        # small-star: a node and its smaller neighbours are tied to the smallest of them
        least_below = scratch.keep(large.groupBy("u").agg(F.min("v").alias("least")), "small-least")
        tied = large.join(least_below, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = scratch.keep(tied.unionByName(least_below.select("u", F.col("least").alias("v"))).distinct(), "small")
        after = _state(small)
        scratch.drop(edges, least, large, least_below)
        edges, done = small, after == state
        state = after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
