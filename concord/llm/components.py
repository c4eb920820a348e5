"""Connected components by alternating stars, on edges of 64-bit node numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.frames import written


#: Edges that one task writes: few edges are written by few tasks, whatever the number of shuffle partitions.
EDGES_A_TASK = 50_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """(a, b) for every node a but the smallest b of its component.

    edges: (a, b), in any direction. In a round each node points its larger neighbours at the
    smallest node it knows, then its smaller ones; both end when nothing changes. The number of
    edges never grows. Every step is written, so both sides of a join are plain shuffles, and
    adaptive execution can split a hub.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges)
    state = _state(edges)
    tasks = 4 + state[0] // EDGES_A_TASK

    def step(df: DataFrame) -> DataFrame:
        return written(df.coalesce(tasks))

    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = step(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = step(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = step(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = step(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges
