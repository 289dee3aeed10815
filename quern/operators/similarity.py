"""Exact nearest-neighbour joins by squared distance over a metric index, and what is built on them.

A few rows of a bounded sample are pivots.  Rows are put in the order of their nearest pivot and the
distance from it, and cut into blocks of ``BLOCK`` rows, and blocks into strips; each knows the least and the largest
distance of its rows from every pivot.  By the triangle inequality two strips can be no nearer to each other
than these rings are, and no farther than their sum: pairs of strips out of reach are never sent anywhere, pairs
of blocks out of reach never multiplied.  The others meet by an equi-join in cells of bounded size, whose number
grows with the data, and matrix products in Arrow batches do the work.  Results are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import cut, release
from .sampling import numbered_in_ranges
from .sequential import first_independent

BLOCK = 1024
#: Blocks of a strip at most, and strips that a group has at least, where it has as many blocks.
STRIP, STRIPS = 16, 8
PIVOTS, SAMPLE = 16, 1024
#: Keys over which the strips of a group are dealt while their rings are compared.
DEAL = 32


def _rows(df: DataFrame, group: Column | None, key: str, vector: str, flag: Column | None) -> DataFrame:
    """(g, key, v, f): a null group is the empty text, others have a letter before them."""
    g = F.lit("g") if group is None else F.coalesce(F.concat(F.lit("g"), group.cast("string")), F.lit(""))
    f = F.lit(0) if flag is None else F.coalesce(flag.cast("int"), F.lit(-1))
    return df.select(g.alias("g"), F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("v"), f.alias("f")).where("v is not null and key is not null")


def _group(g: str) -> Column:
    return F.when(F.col(g) != "", F.substr(F.col(g), F.lit(2))).alias("group")


def choose_pivots(rows: DataFrame, most: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Rows of a sample that are far from each other: each is the farthest from those before it."""
    held = rows.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(sample).select("v").toArrow().column(0)
    if not len(held):
        return np.zeros((0, 0))
    v = np.array(held.to_pylist(), np.float64)
    chosen, far = [0], np.full(len(v), np.inf)
    while len(chosen) < min(most, len(v)):
        far = np.minimum(far, ((v - v[chosen[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return v[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Index:
    """blocks: (g, strip, b, n, keys, vectors, flags, low, high), the last five as bytes; strips: (g,
    strip, n, low, high, strips), arrays of distances from each pivot, and how many strips a group has."""

    blocks: DataFrame
    strips: DataFrame

    def release(self) -> None:
        release(self.blocks, self.strips)


def index(rows: DataFrame, pivots: np.ndarray, block: int = BLOCK) -> Index:
    """The index of (g, key, v, f)."""
    count = len(pivots)

    def place(batches):
        for x in batches:
            if x.num_rows:
                d = np.sqrt(_distances(_vectors(x.column("v")), pivots))
                near = d.argmin(1)
                yield x.append_column("pivot", pa.array(near, pa.int32())).append_column("d", pa.array(d[np.arange(len(near)), near]))

    placed = rows.mapInArrow(place, "g string, key bigint, v array<double>, f int, pivot int, d double") if count else rows.withColumns({"pivot": F.lit(0), "d": F.lit(0.0)})
    numbered, at, all_ = numbered_in_ranges(placed.withColumn("o", F.struct("pivot", "d", "key")), "g", "o")
    blocks = F.ceil(all_ / block)
    per = F.greatest(F.lit(1), F.least(F.lit(STRIP), F.floor(blocks / STRIPS)))
    cells = numbered.select("g", "key", "v", "f", F.floor(at / block).cast("int").alias("b"), F.floor(F.floor(at / block) / per).cast("int").alias("strip"), F.ceil(blocks / per).cast("int").alias("strips"))

    def pack(t: pa.Table) -> pa.Table:
        v = _vectors(t.column("v"))
        # rounding errors widen the rings
        d = np.sqrt(_distances(v, pivots)) if count else np.zeros((len(v), 0))
        low, high = d.min(0) * (1 - 1e-9) - 1e-6, d.max(0) * (1 + 1e-9) + 1e-6
        one = lambda name: t.column(name)[0].as_py()
        raw = [t.column("key").to_numpy(), v, t.column("f").to_numpy(), low, high]
        made = [pa.array([one("g")]), pa.array([one("strip")], pa.int32()), pa.array([one("strips")], pa.int32()), pa.array([one("b")], pa.int32()), pa.array([len(v)], pa.int64()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in raw]]
        return pa.table([*made, pa.array([list(low)], pa.list_(pa.float64())), pa.array([list(high)], pa.list_(pa.float64()))], names=["g", "strip", "strips", "b", "n", "keys", "vectors", "flags", "low", "high", "lows", "highs"])

    packed = cut(cells.groupBy("g", "b").applyInArrow(pack, "g string, strip int, strips int, b int, n bigint, keys binary, vectors binary, flags binary, low binary, high binary, lows array<double>, highs array<double>"))
    release(numbered)
    rings = lambda f, name: F.array(*[f(F.get(name, F.lit(i))) for i in range(count)]) if count else F.array().cast("array<double>")
    strips = packed.groupBy("g", "strip").agg(F.sum("n").alias("n"), rings(F.min, "lows").alias("low"), rings(F.max, "highs").alias("high"), F.first("strips").alias("strips"))
    return Index(packed, cut(strips))


def _least(low, high, low2, high2) -> Column:
    """The least distance between two strips: the widest gap between their rings."""
    gaps = F.zip_with(F.zip_with(low, high2, lambda a, b: a - b), F.zip_with(low2, high, lambda a, b: a - b), lambda a, b: F.greatest(a, b))
    return F.greatest(F.coalesce(F.array_max(gaps), F.lit(0.0)), F.lit(0.0))


def _most(high, high2) -> Column:
    """The largest distance between rows of two strips."""
    return F.coalesce(F.array_min(F.zip_with(high, high2, lambda a, b: a + b)), F.lit(float("inf")))


def _strip_pairs(left: DataFrame, right: DataFrame, on_group: bool) -> DataFrame:
    """All pairs of strips (of a group) as (g, s, g2, t, n, least, most); a group's are dealt over ``DEAL`` keys."""
    deal = lambda x: F.pmod(x, F.lit(DEAL))
    a = left.select("g", F.col("strip").alias("s"), F.col("low").alias("l1"), F.col("high").alias("h1"), deal(F.col("strip")).alias("k"))
    b = right.select(F.col("g").alias("g2"), F.col("strip").alias("t"), "n", F.col("low").alias("l2"), F.col("high").alias("h2"), F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("k2"))
    on = F.col("k") == F.col("k2")
    met = a.join(b, on & (F.col("g") == F.col("g2")) if on_group else on)
    return met.select("g", "s", "g2", "t", "n", _least("l1", "h1", "l2", "h2").alias("least"), _most("h1", "h2").alias("most"))


CELL = ["g", "s", "g2", "t"]
HELD = ["b", "keys", "vectors", "flags", "low", "high"]


def _met(left: Index, right: Index, pairs: DataFrame, same: bool, work: Callable, schema: str) -> DataFrame:
    """``work(group, block, other, whether they are one)`` gives columns for each pair of blocks."""
    a = left.blocks.withColumnRenamed("strip", "s").join(pairs.select(*CELL), ["g", "s"]).select(*CELL, *[F.col(c).alias(f"{c}1") for c in HELD])
    b = right.blocks.withColumnRenamed("strip", "t").withColumnRenamed("g", "g2").join(pairs.select(*CELL), ["g2", "t"]).select(*CELL, *[F.col(c).alias(f"{c}2") for c in HELD])
    met = a.join(b, CELL)
    if same:
        met = met.where((F.col("s") < F.col("t")) | (F.col("b1") <= F.col("b2")))
    names = [x.split()[0] for x in schema.split(", ")]

    def side(batch, r: int, which: int) -> dict:
        out = {n: np.frombuffer(batch.column(f"{n}{which}")[r].as_py(), t) for n, t in (("keys", np.int64), ("vectors", np.float64), ("flags", np.int32), ("low", np.float64), ("high", np.float64))}
        return out | {"vectors": out["vectors"].reshape(len(out["keys"]), -1), "b": batch.column(f"b{which}")[r].as_py()}

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                one, other = side(batch, r, 1), side(batch, r, 2)
                is_same = same and one["b"] == other["b"]
                gap = max(0.0, np.maximum(one["low"] - other["high"], other["low"] - one["high"]).max(initial=0.0))
                yield pa.RecordBatch.from_arrays(work(batch.column("g2")[r].as_py(), one, other, is_same, gap), names=names)

    return met.mapInArrow(run, schema)


def small_batches(spark, rows: int = 64) -> None:
    """Arrow batches of blocks must be short; a session's tighter bound stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= 2000:
        spark.conf.set(name, "2000")
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(size)).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= 16_000_000:
        spark.conf.set(size, "16000000")


def pairs_within(df: DataFrame, threshold: float, key: str, vector: str, group: str | None = None, flag: Column | None = None, block: int = BLOCK) -> DataFrame:
    """(group, a, b, distance) of all pairs a < b of a group with squared distance <= ``threshold``.

    ``flag``: a condition; only rows that agree on it are compared.  Null vectors and keys have no pairs.
    """
    small_batches(df.sparkSession)
    rows = _rows(df, F.col(group) if group else None, key, vector, flag)
    held = index(rows, choose_pivots(rows), block)
    reach = float(np.sqrt(max(threshold, 0.0)))
    pairs = cut(_strip_pairs(held.strips, held.strips, True).where((F.col("s") <= F.col("t")) & (F.col("least") <= reach)).select(*CELL))

    def work(g, one, other, same, gap):
        if gap > reach:
            d = np.zeros((0, 0))
        else:
            d = _distances(one["vectors"], other["vectors"])
        i, j = np.nonzero((d <= threshold + 1e-12) & (one["flags"][:, None] == other["flags"][None])) if d.size else (np.zeros(0, int), np.zeros(0, int))
        ka, kb = one["keys"][i], other["keys"][j]
        ok = ka < kb if same else ka != kb
        ka, kb = ka[ok], kb[ok]
        return [pa.array([g] * len(ka), pa.string()), pa.array(np.minimum(ka, kb)), pa.array(np.maximum(ka, kb)), pa.array(d[i[ok], j[ok]] if d.size else np.zeros(0))]

    found = _met(held, held, pairs, True, work, "g string, a bigint, b bigint, distance double")
    return found.select(_group("g"), "a", "b", "distance")


def nearest(probes: DataFrame, history: DataFrame, k: int, key: str, vector: str, history_key: str, history_group: str | None = None, block: int = BLOCK) -> DataFrame:
    """(key, group, other, distance, rank): the ``k`` nearest rows of each group of ``history``, for each
    probe; ties go to the smaller key. Each block pair yields ``k`` rows a probe at most.

    A strip of the history is left out if ``k`` rows of its group are nearer to all probes of a strip than
    it can be to any.
    """
    small_batches(probes.sparkSession)
    asked = _rows(probes, None, key, vector, None)
    known = _rows(history, F.col(history_group) if history_group else None, history_key, vector, None)
    pivots = choose_pivots(known)
    left, right = index(asked, pivots, block), index(known, pivots, block)
    pairs = _strip_pairs(left.strips, right.strips, False)
    group = Window.partitionBy("g", "s", "g2")
    sofar = F.sum("n").over(group.orderBy("most", "t").rowsBetween(Window.unboundedPreceding, 0))
    pairs = pairs.withColumn("sofar", sofar).withColumn("bound", F.min(F.when(F.col("sofar") >= k, F.col("most"))).over(group))
    pairs = cut(pairs.where(F.col("bound").isNull() | (F.col("least") <= F.col("bound"))).select(*CELL))

    def work(g, one, other, same, gap):
        d = _distances(one["vectors"], other["vectors"])
        order = np.lexsort((np.broadcast_to(other["keys"], d.shape), d), axis=1)[:, :k]
        n = order.shape[1]
        return [pa.array(np.repeat(one["keys"], n)), pa.array([g] * (len(d) * n), pa.string()), pa.array(other["keys"][order].ravel()), pa.array(np.take_along_axis(d, order, 1).ravel())]

    found = _met(left, right, pairs, False, work, "key bigint, g string, other bigint, distance double")
    best = Window.partitionBy("key", "g").orderBy("distance", "other")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("key", _group("g"), "other", "distance", "rank")


def too_similar(probes: DataFrame, history: DataFrame, threshold: float, key: str, vector: str, history_key: str, default: float = 0.35) -> DataFrame:
    """(key, too_similar) of each probe: the nearest row of ``history`` is within the threshold.
    A threshold of 0 stands for the default; against an empty history nothing is too similar."""
    t = threshold or default
    near = nearest(probes, history, 1, key, vector, history_key).select(F.col("key").alias("__key"), (F.col("distance") <= t).alias("near"))
    return probes.join(near, F.col(key) == F.col("__key"), "left").select(key, F.coalesce("near", F.lit(False)).alias("too_similar"))


def drop_similar(batch: DataFrame, history: DataFrame, threshold: float, key: str, vector: str, history_key: str, default: float = 0.35) -> DataFrame:
    """Rows of a batch that are not too similar to ``history``; inside the batch nothing is compared."""
    near = too_similar(batch, history, threshold, key, vector, history_key, default).where("too_similar").select(F.col(key).alias("__key"))
    return batch.join(near, F.col(key) == F.col("__key"), "left_anti")


def greedy_dedup(df: DataFrame, threshold: float, key: str, vector: str, group: str | None = None) -> DataFrame:
    """Rows that a sequential pass in key order keeps."""
    pairs = pairs_within(df, threshold, key, vector, group).select("a", "b")
    kept = first_independent(df.select(F.col(key).cast("bigint").alias("key")), pairs)
    return df.join(kept, df[key] == kept["key"], "left_semi")
