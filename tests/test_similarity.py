import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import vector as V
from quern.operators import routing, similarity
from quern.plans import cull as C


def vectors(spark, n=120, seed=0, groups=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 2] = v[3]
    rows = [(i, str(i % groups), [float(x) for x in v[i]], int(rng.integers(0, 3)), int(rng.integers(1, 5))) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, g string, v array<double>, good int, size int"), v


def test_pairs(spark):
    df, v = vectors(spark)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if d[i, j] <= 0.3 and i % 3 == j % 3}
    for block in (7, 1000):
        got = similarity.pairs_within(df, 0.3, "id", "v", "g", block=block).collect()
        assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)
    a, b = df.select(F.col("id").alias("a"), F.col("v").alias("u")), df.select(F.col("id").alias("b"), "v")
    plain = a.join(b, F.col("a") < F.col("b")).where(V.squared_distance(F.col("u"), F.col("v")) <= 0.3).collect()
    assert {(r["a"], r["b"]) for r in plain} == {(i, j) for i in range(120) for j in range(i + 1, 120) if d[i, j] <= 0.3}


@pytest.mark.parametrize("t", [0.1, 0.4, 0.9])
def test_greedy_is_sequential(spark, t):
    df, v = vectors(spark)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    kept = []
    for i in range(120):
        if all(d[i, j] > t for j in kept):
            kept.append(i)
    assert sorted(r["id"] for r in similarity.greedy_dedup(df, t, "id", "v").collect()) == kept


def test_too_similar_and_empty_history(spark):
    df, v = vectors(spark)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    got = {r["id"]: r["too_similar"] for r in similarity.too_similar(df.where("id < 60"), df.where("id >= 60"), 0.3, "id", "v", "id").collect()}
    assert got == {i: bool(d[i, 60:].min() <= 0.3) for i in range(60)}
    assert not any(r["too_similar"] for r in similarity.too_similar(df, df.limit(0), 0.3, "id", "v", "id").collect())
    zero = {r["id"]: r["too_similar"] for r in similarity.too_similar(df.where("id < 60"), df.where("id >= 60"), 0, "id", "v", "id").collect()}
    assert zero == {i: bool(d[i, 60:].min() <= 0.35) for i in range(60)}


def test_router(spark):
    df, v = vectors(spark)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    got = {r["id"]: r["expert"] for r in routing.route(df.where("id < 9"), df, 5, "id", "v", "id", "g").collect()}
    for i in range(9):
        best = min(("0", "1", "2"), key=lambda g: (np.mean(sorted(d[i, int(g) :: 3])[:5]), g))
        assert got[i] == best


def sequential_cull(n, edges, good, size):
    purged, saved = set(), set()
    after = {i: sorted(j for a, j in edges if a == i) for i in range(n)}
    for i in range(n):
        if i in purged or i in saved:
            continue
        batch = [i] + [j for j in after[i] if j not in purged and j not in saved]
        fine = [j for j in batch if good[j]]
        if not fine:
            purged |= set(batch)
        elif len(fine) == 1:
            saved.add(fine[0])
            if fine[0] != i:
                purged.add(i)
        else:
            best = max(fine, key=lambda j: (size[j], j))
            saved.add(best)
            purged |= set(batch) - {best}
    return saved


@pytest.mark.parametrize("t,seed", [(0.4, 1), (0.9, 2), (1.4, 3)])
def test_cull_is_sequential(spark, t, seed):
    df, v = vectors(spark, 90, seed, 1)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    rows = {r["id"]: r for r in df.collect()}
    edges = [(i, j) for i in range(90) for j in range(i + 1, 90) if d[i, j] <= t]
    want = sequential_cull(90, edges, [rows[i]["good"] > 0 for i in range(90)], [rows[i]["size"] for i in range(90)])
    got = C.cull(df.withColumnRenamed("g", "category"), t, "id", "v", size=F.col("size"), good=F.col("good") > 0)
    assert {r["id"] for r in got.collect()} == want


def test_cull_passes_and_plain_format(spark):
    v = [1.0, 0.0]
    rows = [(1, "rp", "a", "b", v), (2, "rp", "a", "b", v), (3, "coding", "x PLAINFORMAT", "b", v), (4, "coding", "x", "b", v), (5, "coding", "x", "longer", v)]
    df = spark.createDataFrame(rows, "rid bigint, category string, instruction string, response string, embedding array<double>")
    assert sorted(r["rid"] for r in C.cull(df, 0.1).collect()) == [1, 2, 3, 5]


def test_vectors(spark):
    r = spark.range(1).select(
        V.norm(F.array(F.lit(3.0), F.lit(4.0))).alias("n"),
        V.normalised(F.array(F.lit(0.0), F.lit(0.0))).alias("z"),
        V.masked_mean(F.array(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(9.0), F.lit(9.0)), F.array(F.lit(3.0), F.lit(4.0))), F.array(F.lit(1), F.lit(0), F.lit(1))).alias("m"),
        V.fragments(F.lit(" a b  c d e "), 2).alias("f"),
    ).first()
    assert (r["n"], r["z"], r["m"], r["f"]) == (5.0, [0.0, 0.0], [2.0, 3.0], ["a b", "c d", "e"])
    e = spark.createDataFrame([("hello world",), ("hello worlds",), ("zzz qqq",), (None,)], "t string").select(V.embedder(64)("t").alias("e")).collect()
    a, b, c = (np.array(x["e"]) for x in e[:3])
    assert ((a - b) ** 2).sum() < ((a - c) ** 2).sum() and abs(np.linalg.norm(a) - 1) < 1e-5


def clustered(spark, n=400, seed=5):
    """Tight clusters far from each other, one of them with a third of all rows."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, 6)) * 10
    which = np.where(rng.random(n) < 0.34, 0, rng.integers(0, 12, n))
    v = centre[which] + rng.normal(size=(n, 6)) * 0.3
    v[n // 2] = v[3]
    rows = [(i, str(i % 2) if i % 7 else None, [float(x) for x in v[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, g string, v array<double>"), v


def test_rings_prune_and_lose_nothing(spark, monkeypatch):
    df, v = clustered(spark)
    monkeypatch.setattr(similarity, "STRIP", 2)
    d = ((v[:, None] - v[None]) ** 2).sum(2)
    group = [str(i % 2) if i % 7 else None for i in range(len(v))]
    met = []
    real = similarity._met
    monkeypatch.setattr(similarity, "_met", lambda left, right, pairs, *rest: (met.append((left.strips.count(), right.strips.count(), pairs.count())), real(left, right, pairs, *rest))[1])

    got = similarity.pairs_within(df, 0.5, "id", "v", block=4).collect()
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if d[i, j] <= 0.5}
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want and len(want) > 500
    n, _, pairs = met.pop()
    assert n >= 40 and pairs < 0.3 * n * (n + 1) / 2

    got = similarity.nearest(df, df, 3, "id", "v", "id", "g", block=4).collect()
    want = {(i, g, r, j) for i in range(len(v)) for g in ("0", "1", None) for r, j in enumerate(sorted((j for j in range(len(v)) if group[j] == g), key=lambda j: (d[i, j], j))[:3], 1)}
    assert {(r["key"], r["group"], r["rank"], r["other"]) for r in got} == want
    asked, known, pairs = met.pop()
    assert pairs < 0.7 * asked * known  # strips of eight rows cross clusters


def test_cells_follow_the_data(spark):
    df = spark.range(3000).select(F.col("id"), F.array(F.rand(1), F.rand(2)).alias("v"))
    rows = similarity._rows(df, None, "id", "v", None)
    for block, strips in ((16, 12), (64, 9)):
        held = similarity.index(rows, similarity.choose_pivots(rows), block)
        assert held.strips.count() >= strips and held.blocks.agg(F.max("n")).first()[0] == block
        held.release()
