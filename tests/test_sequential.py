"""Outcomes of a sequential pass, against the loop itself."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.operators import sequential
from quern.plans import cull as C

from .test_similarity import sequential_cull


def graph(seed, n=60, shape="random"):
    r = random.Random(seed)
    if shape == "chain":
        return [(i, i + 1) for i in range(n - 1)]
    if shape == "hub":
        return sorted({(3, j) for j in range(4, n)} | {(1, 5), (2, 9), (10, 40)} | {tuple(sorted(r.sample(range(n), 2))) for _ in range(20)})
    return sorted({tuple(sorted(r.sample(range(n), 2))) for _ in range(2 * n)})


def tables(spark, n, edges, good, size):
    nodes = spark.createDataFrame([(i, good[i], size[i]) for i in range(n)], "key bigint, good boolean, size bigint")
    return nodes, spark.createDataFrame([*edges, *edges[:3]], "a bigint, b bigint")


@pytest.mark.parametrize("shape", ["random", "chain", "hub"])
@pytest.mark.parametrize("size", [9, 40])
def test_any_cut_gives_the_loop(spark, shape, size):
    n, r = 60, random.Random(size)
    edges = graph(size, n, shape)
    good, sizes = [r.random() < 0.6 for _ in range(n)], [r.randint(1, 4) for _ in range(n)]
    nodes, links = tables(spark, n, edges, good, sizes)
    kept = []
    for i in range(n):
        if not any((j, i) in edges for j in kept):
            kept.append(i)
    assert sorted(x["key"] for x in sequential.first_independent(nodes, links, size).collect()) == kept
    out = {x["key"]: x["outcome"] for x in C.resolve(nodes, links, size).collect()}
    assert len(out) == n and {k for k, v in out.items() if v == "kept"} == sequential_cull(n, edges, good, sizes)


def test_no_edges_nulls_and_no_rows(spark):
    nodes, links = tables(spark, 3, [], [True, False, None], [None, 1, 2])
    assert sorted(x["key"] for x in sequential.first_independent(nodes, links).collect()) == [0, 1, 2]
    assert {x["key"]: x["outcome"] for x in C.resolve(nodes, links).collect()} == {0: "kept", 1: "purged", 2: "kept"}
    assert sequential.first_independent(nodes.limit(0), links).count() == C.resolve(nodes.limit(0), links).count() == 0


def test_ranges_and_their_numbers(spark):
    edges = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    bounds = sequential.ranges(edges, "b", 100)
    assert 8 <= len(bounds) <= 9
    got = spark.range(-5, 1010).select("id", sequential.range_of("id", bounds).alias("r")).collect()
    assert all(x["r"] == sum(b < x["id"] for b in bounds) for x in got)


def jobs(spark, run):
    spark.sparkContext.setJobGroup(name := f"g{random.random()}", "")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_long_chain_takes_few_jobs(spark):
    n = 10_000
    nodes = spark.range(n).select(F.col("id").alias("key"), F.lit(True).alias("good"), F.lit(1).alias("size"))
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which makes a job of each stage
    try:
        rows = []
        assert jobs(spark, lambda: rows.extend(sequential.first_independent(nodes, links).collect())) <= 20
        assert sorted(x["key"] for x in rows) == list(range(0, n, 2))
        rows.clear()
        assert jobs(spark, lambda: rows.extend(C.resolve(nodes, links).collect())) <= 20
        # of each two neighbours the later one stays
        assert sorted(x["key"] for x in rows if x["outcome"] == "kept") == list(range(1, n, 2))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def peak(run):
    """Bytes that Python and numpy hold at most, and the result."""
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1], out
    finally:
        tracemalloc.stop()


def test_a_range_of_edges_takes_few_bytes_each():
    n, rng = 200_000, np.random.default_rng(1)
    a = rng.integers(0, 5000, n)
    b = a + rng.integers(1, 50_000, n)
    leaders = np.unique(a)
    a, b = np.concatenate([a, leaders]), np.concatenate([b, leaders])
    none = pa.nulls(len(a), pa.int64())
    t = pa.table({"a": a, "b": b, "good": pa.array(b % 2 == 0), "size": b % 7, "claim": none.cast(pa.int32()), "hub": none})
    most, (keys, kept) = peak(lambda: C._in_order(0, t))
    assert len(keys) and kept.any() and most < 150 * len(a)
    nodes = np.unique(np.concatenate([a, b]))
    edge = a != b
    t = pa.table({"a": pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(a[edge])]), "b": np.concatenate([nodes, b[edge]]), "foreign": np.zeros(len(nodes) + edge.sum(), bool)})
    most, (keys, kept) = peak(lambda: sequential._in_order(t))
    assert keys.tolist() == nodes.tolist() and kept.any() and most < 150 * len(t)
