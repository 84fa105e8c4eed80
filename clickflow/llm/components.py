"""Connected components of a large graph by alternating large-star and small-star rounds.

Each round hooks neighbours to the least node near them (a distributed union-find with path
shortening); the number of rounds grows with the logarithm of the longest path. The edges of
each round are written to the shared folder, so lost executors repeat one round at most.
Hubs are reduced by map-side minima. The minima are written too: a join then finds them broadcast
(measured) or between two plain shuffles, where adaptive execution splits the edges of a hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import discard, join_measured, saved


def _state(edges: DataFrame) -> tuple:
    """What tells one set of edges from another (one row)."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the least node it is connected
    with. Edges of a node with itself are ignored."""
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = join_measured(both.where("v > u"), least, ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "cc-large")
        near = saved(large.groupBy("u").agg(F.min("v").alias("m")), "cc-near")
        small = join_measured(large, near, ["u"], "inner").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        made = saved(small.unionByName(near.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        after = _state(made)
        discard(now, least, large, near)
        now, done, state = made, after == state, after
        if done:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
