"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum, which is pre-aggregated, and a join on a node.  A hub's edges meet in
one partition of that join, two numbers each; adaptive execution splits it where it is large.  Each
round is written to the shared folder and the one before deleted; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import release, stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    # a < b in every edge here: each node b has its smaller neighbours
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("a").alias("b"), F.col("m").alias("a")).where("a <> b")
    return moved.unionAll(least.select("b", F.col("m").alias("a"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``edges`` (bigint columns a, b): the component's least id.

    Repeated edges, loops and either direction are allowed; an empty table gives an empty one.
    """
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    now, seen = stage(now, "cc"), None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now, before = stage(_small(_large(now)), "cc"), now
        release(before)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    out = stage(now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionAll(roots), "cc")
    release(now)
    return out
