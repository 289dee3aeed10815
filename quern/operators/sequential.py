"""What a loop over rows in the order of their keys would decide, over an edge table, without the loop.

Keys are cut into ranges of about equally many edges.  In a round every range is gone through in order by
itself, inside one Arrow group; a row whose outcome hangs on an open row of an earlier range stays open.
So a round settles at least all of the first open range, whatever the edges are: there are no more
rounds than ranges, and a chain of neighbours inside a range is one round.  Only open rows go on to the
next round.  Edges from other ranges are counted before, not gathered, so that a range holds its own
edges only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut, release

#: Edges of a range, about.
RANGE = 500_000


def ranges(edges: DataFrame, end: str, size: int = RANGE) -> list[int]:
    """Upper bounds of the ranges but the last: quantiles of an end's keys, one for ``size`` edges."""
    n = edges.count()
    parts = -(-n // size)
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = edges.agg(F.percentile_approx(end, cuts, 100 * parts)).first()[0]
    return sorted(set(found))


def range_of(key, bounds: list[int]) -> Column:
    """The number of a key's range: how many bounds are smaller. The bounds are a sorted array, of
    which the place is found by halving."""
    k = F.col(key) if isinstance(key, str) else key
    if not bounds:
        return F.when(k.isNotNull(), 0)
    held = F.expr("cast(split('" + ",".join(map(str, bounds)) + "', ',') as array<bigint>)")
    low, high = F.lit(0), F.lit(len(bounds))
    both = lambda a, b: F.struct(a.alias("low"), b.alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        below = F.get(held, middle) < k
        open_ = acc["low"] < acc["high"]
        return both(F.when(open_ & below, middle + 1).otherwise(acc["low"]), F.when(open_ & ~below, middle).otherwise(acc["high"]))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.when(k.isNotNull(), F.aggregate(steps, both(low, high), halve, lambda acc: acc["low"]))


def _in_order(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(keys decided, kept or not) of the nodes of a range.  t: (a, b, foreign): rows without ``a`` are
    nodes b, those that are foreign say that b has an open neighbour in an earlier range; the others are
    edges inside the range.  Edges and nodes stay in arrays: no Python object for each."""
    lone, foreign, b = t.column("a").is_null().to_numpy(), t.column("foreign").to_numpy(), t.column("b").to_numpy()
    keys = np.unique(b[lone & ~foreign])
    # of a node: 0 not decided, 1 kept, 2 gone
    state, waiting = bytearray(len(keys)), bytearray(np.isin(keys, b[foreign]).tobytes())
    edges = t.filter(pc.is_valid(t.column("a")))
    earlier, node = np.searchsorted(keys, edges.column("a").to_numpy()), np.searchsorted(keys, edges.column("b").to_numpy())
    order = np.argsort(node)
    earlier, node = earlier[order], node[order]
    numbers = np.arange(len(keys))
    for i, (start, end) in enumerate(zip(np.searchsorted(node, numbers), np.searchsorted(node, numbers, "right"), strict=True)):
        before = {state[x] for x in earlier[start:end].tolist()}
        if 1 in before:
            state[i] = 2
        elif not waiting[i] and 0 not in before:
            state[i] = 1
    decided = np.frombuffer(state, np.uint8)
    found = np.flatnonzero(decided)
    return keys[found], decided[found] == 1


def first_independent(nodes: DataFrame, edges: DataFrame, size: int = RANGE) -> DataFrame:
    """(key) that a sequential pass in key order would keep: a row goes if an earlier kept row is its
    neighbour. nodes: (key); edges: (a, b) with a < b, repeats allowed."""
    left = cut(edges.select("a", "b").distinct())
    bounds = ranges(left, "b", size)
    open_ = cut(left.select(F.col("a").alias("key")).union(left.select("b")).distinct())
    kept = nodes.select("key").distinct().join(cut(open_), "key", "left_anti")
    done = open_.limit(0).withColumn("kept", F.lit(True))

    def settle(t: pa.Table) -> pa.Table:
        key, kept = _in_order(t)
        return pa.table([pa.array(key, pa.int64()), pa.array(kept, pa.bool_())], names=["key", "kept"])

    while not open_.isEmpty():
        placed = left.select(range_of("b", bounds).alias("own"), range_of("a", bounds).alias("other"), "a", "b")
        none, no = F.lit(None).cast("bigint").alias("a"), F.lit(False).alias("foreign")
        inside = placed.where("own = other").select("own", "a", "b", no)
        # an edge from another range counts, but is not gathered: one row for each node
        foreign = placed.where("own <> other").select("own", none, "b", F.lit(True).alias("foreign")).distinct()
        rows = open_.select(range_of("key", bounds).alias("own"), none, F.col("key").alias("b"), no)
        now = cut(rows.unionAll(inside).unionAll(foreign).groupBy("own").applyInArrow(settle, "key bigint, kept boolean"))
        # a row kept in this range sends away its neighbours in later ones
        sent = left.join(now.where("kept").select(F.col("key").alias("a")), "a", "left_semi").select(F.col("b").alias("key")).distinct().join(now, "key", "left_anti")
        decided = cut(now.unionAll(sent.withColumn("kept", F.lit(False))))
        done, last = cut(done.unionAll(decided)), done
        keys = decided.select("key")
        before = open_, left
        open_ = cut(open_.join(keys, "key", "left_anti"))
        left = cut(left.join(keys.toDF("a"), "a", "left_anti").join(keys.toDF("b"), "b", "left_anti"))
        release(now, decided, last, *before)
    release(open_, left)
    return kept.unionAll(done.where("kept").select("key"))
