"""Culling: per category, near rows form the batch of their first open row; one good row stays.

The order of rows matters; ``resolve`` gives the result of a sequential pass, with a row in no batch
after it was kept or purged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import filters
from ..operators.sequential import RANGE, range_of, ranges
from ..operators.similarity import pairs_within
from ..storage import cut, release


def _in_order(own: int, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(keys settled, kept or not) of a range whose leaders are gone through in order.  t: (a, b, good, size,
    claim, hub), with a row a = b for each leader; the last four tell of b, ``claim`` the range of its first
    open earlier neighbour, ``hub`` its first neighbour that is judged elsewhere.  A batch with a member
    that an open row of an earlier range, an earlier row judged elsewhere, or an unsettled row of this
    range may claim is left for another round, and so are its members.

    Edges and members stay in arrays: no Python object for each."""
    none = np.iinfo(np.int64).max
    column = lambda name, null: pc.fill_null(pc.cast(t.column(name), pa.int64()), null).to_numpy()
    a, b = column("a", none), column("b", none)
    keys, first, member = np.unique(b, return_index=True, return_inverse=True)
    good, size, hub = column("good", 0)[first].astype(bool).tobytes(), column("size", -1)[first], column("hub", none)[first]
    unsure = bytearray((column("claim", none)[first] < own).tobytes())
    leaders = member[a == b]
    leaders.sort()
    edge = a != b
    a, near = a[edge], member[edge]
    order = np.argsort(a)
    a, near = a[order], near[order]
    starts, ends = np.searchsorted(a, keys[leaders]), np.searchsorted(a, keys[leaders], "right")
    hubs = bool((hub < none).any())
    done, kept = bytearray(len(keys)), bytearray(len(keys))
    for leader, start, end in zip(leaders, starts, ends, strict=True):
        leader = int(leader)
        if done[leader]:
            continue
        batch = [leader, *(m for m in near[start:end].tolist() if not done[m])]
        if any(unsure[m] for m in batch) or hubs and any(hub[m] < keys[leader] for m in batch):
            for m in batch:
                unsure[m] = 1
            continue
        fine = [m for m in batch if good[m]]
        # the longest, the last of equal ones: members are numbered in the order of their keys
        best = max(fine, key=lambda m: (size[m], m)) if fine else None
        # a single good member leaves the bad ones open, but for the leader
        for m in (leader, best) if len(fine) == 1 else batch:
            done[m], kept[m] = 1, m == best
    found = np.flatnonzero(np.frombuffer(done, np.uint8))
    return keys[found], np.frombuffer(kept, np.uint8)[found].astype(bool)


def resolve(nodes: DataFrame, edges: DataFrame, size: int = RANGE) -> DataFrame:
    """(key, outcome: kept or purged). nodes: (key, good, size); edges: (a, b) with a < b.

    A leader's batch is the leader and its open later neighbours.  No good member: all go.  One: it
    stays, the leader and the bad ones are settled only if they are not it - bad members stay open
    for later batches, a bad leader is done.  Several: the longest stays (the last of equal ones),
    the others go.  Null sizes count as the least.

    Leaders of a range of keys are gone through in order inside one Arrow group (``sequential``).  A
    leader of more later neighbours than a range holds edges is no part of a group: its batch is
    judged by aggregates.
    """
    nodes = nodes.select("key", F.coalesce("good", F.lit(True)).alias("good"), F.coalesce(F.col("size").cast("bigint"), F.lit(-1)).alias("size"))
    left = cut(edges.select("a", "b").distinct())
    touched = left.select(F.col("a").alias("key")).union(left.select("b")).distinct()
    alone = nodes.join(touched, "key", "left_anti").select("key", F.col("good").alias("kept"))
    open_ = cut(nodes.join(touched, "key", "left_semi"))
    bounds = ranges(left, "a", size)
    done = cut(alone)

    def settle(t: pa.Table) -> pa.Table:
        key, kept = _in_order(t.column("own")[0].as_py(), t)
        return pa.table([pa.array(key, pa.int64()), pa.array(kept, pa.bool_())], names=["key", "kept"])

    while not open_.isEmpty():
        # there are at most (edges / size) hubs
        hubs = cut(left.groupBy("a").count().where(F.col("count") > size).select("a", F.col("a").alias("hub")))
        some = not hubs.isEmpty()
        # the first range, the first row and the first hub that may still claim a row
        marked = left.join(F.broadcast(hubs), "a", "left") if some else left.withColumn("hub", F.lit(None).cast("bigint"))
        first = marked.groupBy(F.col("b").alias("key")).agg(F.min("a").alias("first"), F.min("hub").alias("hub"))
        member = open_.join(first, "key", "left").withColumn("claim", range_of("first", bounds)).withColumnRenamed("key", "b")
        batches = member.select(F.col("b").alias("a"), *member.columns).unionAll(left.join(member, "b").select("a", *member.columns))
        placed = batches.withColumn("own", range_of("a", bounds))
        placed = cut(placed) if some else placed
        ordinary = placed.join(F.broadcast(hubs.select("a")), "a", "left_anti") if some else placed
        decided = ordinary.groupBy("own").applyInArrow(settle, "key bigint, kept boolean")
        if some:
            # a hub's batch is ready if it comes first for each of its members
            wide = placed.join(F.broadcast(hubs.select("a")), "a", "left_semi")
            ready = wide.groupBy("a").agg(F.min(F.when(F.col("b") == F.col("a"), F.col("first").isNull()).otherwise(F.col("first") == F.col("a"))).alias("ready"), F.count_if("good").alias("n"), F.max_by("b", F.struct("good", "size", "b")).alias("best"))
            judged = wide.join(ready.where("ready"), "a").select(F.col("b").alias("key"), F.when(F.col("n") == 0, False).when(F.col("b") == F.col("best"), True).when((F.col("n") > 1) | (F.col("a") == F.col("b")), False).alias("kept")).where("kept is not null")
            decided = decided.unionAll(judged)
        decided = cut(decided)
        keys = decided.select("key")
        before = open_, left, hubs, placed, done, decided
        done = cut(done.unionAll(decided))
        open_ = cut(open_.join(keys, "key", "left_anti"))
        left = cut(left.join(keys.toDF("a"), "a", "left_anti").join(keys.toDF("b"), "b", "left_anti"))
        release(*before)
    release(open_, left)
    return done.select("key", F.when(F.col("kept"), "kept").otherwise("purged").alias("outcome"))


def cull(df: DataFrame, threshold: float, key: str = "rid", vector: str = "embedding", category: str = "category", size=None, good=None, passing=filters.PASS_THROUGH) -> DataFrame:
    """Rows that culling keeps.  Categories of ``passing`` go through as they are; coding rows are
    compared only with rows that agree on asking for a plain format.  A threshold of 0 is the default.
    """
    through, rest = filters.split_pass_through(df, category, passing)
    t = threshold or 0.35
    plain = F.when(F.col(category) == "coding", F.contains("instruction", F.lit("PLAINFORMAT"))).otherwise(False) if "instruction" in df.columns else F.lit(False)
    pairs = pairs_within(rest, t, key, vector, category, plain)
    size = size if size is not None else F.length(F.concat("instruction", "response"))
    nodes = rest.select(F.col(key).alias("key"), (good if good is not None else F.lit(True)).alias("good"), size.alias("size"))
    kept = resolve(nodes, pairs.select("a", "b")).where("outcome = 'kept'").select(F.col("key").alias("__key"))
    return through.unionByName(rest.join(kept, F.col(key) == F.col("__key"), "left_semi"))


def resumed(df: DataFrame, threshold: float, output: str, state: str, key: str = "rid", **options) -> int:
    """Culls what earlier runs have not processed: rows kept go to ``output``, the keys of all rows
    processed to ``state``, each in a folder of the run. Returns the run's number.

    A run that was cut off is done again under the same number and replaces what it left, so no row
    is written twice.  Rows of earlier runs are not compared with again.  To start over, delete both.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(state)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    run = 0
    # a run counts once its state is complete
    while files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/run={run}/_SUCCESS")):
        run += 1
    todo = df
    if run:
        done = spark.read.parquet(*[f"{state}/run={i}" for i in range(run)]).select(F.col(key).alias("__done"))
        todo = df.join(done, F.col(key) == F.col("__done"), "left_anti")
    todo = cut(todo)
    cull(todo, threshold, key, **options).write.mode("overwrite").parquet(f"{output}/run={run}")
    todo.select(key).write.mode("overwrite").parquet(f"{state}/run={run}")
    return run
