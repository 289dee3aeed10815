"""Mixing sources to target weights, by fixed-length blocks of words.

1. Targets: a budget is shared by weight; no source gets more than ``repeat`` times its size, and
   what such a source leaves is shared again among the others.
2. Blocks: each source's documents, in a pseudorandom order, form one stream of words that is cut
   into blocks of ``block`` words (the last is shorter).
3. Slots: a source fills ``ceil(words / block)`` slots; its last slot is cut where the target is
   reached.  Output shards have ``per_shard`` slots.  How many of a shard's slots each source gets is
   a multinomial draw conditioned on the corpus totals (unconditioned draws would miss a small
   source's target by ``1/sqrt(slots)``).  Draws go down a binary tree of shards: at each node, the
   counts of its left half.  Any run of shards is drawn by itself from the root, with the same result,
   so no task and not the driver holds the counts of all shards.
4. Slot ``k`` of a source uses block ``p(k)`` for a keyed permutation ``p`` of the source's block
   numbers, a new one in each epoch, so every block is used once before any is used again.
5. Slots and blocks are joined by (source, block number): evenly spread keys, whatever the sizes of
   sources are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .workspace import fresh, small_batches, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a table of sources that one task makes targets from; more sources raise an error.
MAX_SOURCES = 100_000
#: Shards whose slots are made from one row.
RUN = 16
#: Slots of a node of the tree of shards up to which its split is drawn; above, it is in proportion.
MOST_DRAWN = 500_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_fill(weights: list[float], caps: list[float], budget: float) -> list[float]:
    """Shares of ``budget`` by weight, none above its cap, the excess shared again by weight."""
    targets, open_ = [0.0] * len(caps), [i for i, c in enumerate(caps) if c > 0 and weights[i] > 0]
    left = float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > caps[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in full:
            targets[i] = float(caps[i])
        left -= sum(caps[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def permute(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of 0..n-1 at ``k``: a four-round Feistel network over the smallest even
    power of two that holds n, walked until the value is below n again."""
    k, n, key = (np.asarray(x).astype(np.uint64) for x in (k, n, key))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    half = np.where((np.uint64(1) << (half * np.uint64(2))) < n, half + np.uint64(1), half)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def rounds(x, half, mask, key):
        left, right = x >> half, x & mask
        for r in range(4):
            z = right + key + np.uint64((0x9E3779B97F4A7C15 * (r + 1)) % 2**64)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((z ^ (z >> np.uint64(31))) & mask)
        return (left << half) | right

    with np.errstate(over="ignore"):
        out, todo = k.copy(), np.arange(len(k))
        while len(todo):
            out[todo] = rounds(out[todo], half[todo], mask[todo], key[todo])
            todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _seeded(seed: int, *parts) -> int:
    return int.from_bytes(hashlib.sha256(repr((seed, *parts)).encode()).digest()[:7], "big")


def split_counts(counts: np.ndarray, left: int, seed: int) -> np.ndarray:
    """How many slots of each source are among ``left`` slots taken from all without replacement."""
    total = int(counts.sum())
    if total <= MOST_DRAWN:
        return np.random.Generator(np.random.Philox(seed)).multivariate_hypergeometric(counts, left, method="marginals")
    whole = [int(c) * left // total for c in counts]
    rest = sorted(range(len(counts)), key=lambda i: (-(int(counts[i]) * left % total), i))
    for i in rest[: left - sum(whole)]:
        whole[i] += 1
    return np.array(whole, np.int64)


def shard_counts(counts: np.ndarray, per_shard: int, first: int, last: int, seed: int):
    """(shard, counts, before) of the shards from ``first`` up to ``last``: each source's slots in the
    shard, and in all shards before it."""
    shards = -(-int(counts.sum()) // per_shard)

    def walk(low, high, counts, before):
        if high <= first or low >= last or low >= high:
            return
        if high - low == 1:
            yield low, counts, before
            return
        middle = (low + high) // 2
        left = split_counts(counts, (middle - low) * per_shard, _seeded(seed, "split", low, high))
        yield from walk(low, middle, left, before)
        yield from walk(middle, high, counts - left, before + left)

    yield from walk(0, shards, counts, np.zeros_like(counts))


def _deal(plans: list[dict], block: int, per_shard: int, seed: int):
    """(rank, block, shard, slot, limit) of all slots of the runs of shards whose first one is given."""
    column = lambda c: np.array([p[c] for p in plans], np.int64)
    slots, blocks, seeds, cut = column("slots"), column("blocks"), column("seed"), column("cut")

    def run(batches):
        for batch in batches:
            for first in batch.column(0).to_pylist():
                out = []
                for shard, counts, before in shard_counts(slots, per_shard, first, first + RUN, seed):
                    n = int(counts.sum())
                    rank = np.repeat(np.arange(len(plans)), counts)
                    k = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts) + before[rank]
                    number = permute(k % blocks[rank], blocks[rank], seeds[rank] + k // blocks[rank])
                    slot = permute(np.arange(n), np.full(n, n), np.full(n, _seeded(seed, "deal", shard)))
                    out.append((rank, number, np.full(n, shard), slot, np.where(k == slots[rank] - 1, cut[rank], block)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out]).astype(np.int64)) for c in range(5)], names=["rank", "block", "shard", "slot", "limit"])

    return run


def plan(sized: DataFrame, source: str, size: str, weights=(3, 1, 2), budget: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """Targets per source: (source, source_size, target, rank).

    Sources are ordered by code point, null last; weights repeat in that order.  ``budget`` is a
    share of all sizes.
    """
    total = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    rows = total.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["source_size"] for r in rows]
    w = [float(weights[i % len(weights)]) for i in range(len(rows))]
    targets = water_fill(w, [repeat * s for s in sizes], budget * sum(sizes))
    made = [(r["source"], s, t, i, r["rows"]) for i, (r, s, t) in enumerate(zip(rows, sizes, targets, strict=True))]
    return sized.sparkSession.createDataFrame(made, "source string, source_size bigint, target double, rank int, source_rows bigint")


def mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=(3, 1, 2), budget: float = 1.5, repeat: float = 2.0, block: int = 512, per_shard: int = 1024, seed: int = 7):
    """Returns two frames.

    ``sizes``: one row per input row, (key, row, size, source_size, target), where ``row`` tells
    rows with equal keys apart.
    ``pieces``: what the mix takes, one row per stretch of a document in a slot: (key, digest, row,
    shard, slot, at, first, words), that is ``words`` words of the document from word ``first`` on,
    at word ``at`` of slot ``slot`` of output shard ``shard``.

    Null texts have size 0 and are never taken.  Null sources are a source of their own, the last.
    Rows with equal keys are separate documents.  Empty tables give empty frames.  Other columns
    are ignored.  Reruns agree: order and draws depend on values and ``seed`` alone.
    """
    spark = df.sparkSession
    small_batches(spark)
    digest = F.xxhash64(F.lit(seed), df[key], df[text])
    sized = df.select(df[key].alias("key"), df[source].cast("string").alias("source"), digest.alias("digest"), word_count(df[text]).alias("size"))
    sized = stage(sized, "mix-sizes")
    targets = plan(sized, "source", "size", weights, budget, repeat)
    plans = [r.asDict() for r in targets.collect()]
    for p in plans:
        p["blocks"] = -(-p["source_size"] // block)
        p["chunks"] = max(1, min(1 << 16, p["source_rows"] // 2_000 + 1))
        p["seed"] = _seeded(seed, p["source"])
        p["slots"], p["cut"] = _slots(p, block)
    shape = "source string, source_size bigint, target double, rank int, source_rows bigint, blocks bigint, chunks bigint, seed bigint, slots bigint, cut bigint"
    order = [f.split()[0] for f in shape.split(", ")]
    dim = spark.createDataFrame([tuple(p[c] for c in order) for p in plans], shape)

    # Where each document starts in its source's stream: totals of chunks, then inside a chunk.
    # The broadcast table has MAX_SOURCES rows at most; slots, which grow, are made from it without the hint.
    rows = sized.join(F.broadcast(dim), sized["source"].eqNullSafe(dim["source"])).select(sized["key"], "digest", "size", "rank", "source_size", "target", F.pmod("digest", "chunks").alias("chunk"))
    per_chunk = rows.groupBy("rank", "chunk").agg(F.sum("size").alias("words"))
    before = per_chunk.select("rank", "chunk", (F.sum("words").over(Window.partitionBy("rank").orderBy("chunk")) - F.col("words")).alias("before"))
    inside = Window.partitionBy("rank", "chunk").orderBy("digest", "key")
    placed = rows.select("*", F.row_number().over(inside).alias("row"), (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("within"))
    placed = stage(placed.join(before, ["rank", "chunk"]).select("key", "digest", F.struct("rank", "chunk", "row").alias("row"), "size", "source_size", "target", "rank", (F.col("before") + F.col("within")).alias("start")), "mix-placed")

    # One row per document and block that share words.
    covered = placed.where("size > 0").select("key", "digest", "row", "size", "rank", "start", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    segments = covered.select("key", "digest", "row", "rank", "block", (low - F.col("start")).alias("first"), (low - F.col("block") * block).alias("offset"), (high - low).alias("words"))

    # One row per slot, made in runs of shards.
    shards = -(-sum(p["slots"] for p in plans) // per_shard)
    runs = spark.range(0, max(1, shards), RUN, max(1, min(10_000, shards // (4 * RUN) + 1))).where(F.col("id") < shards)
    slots = runs.mapInArrow(_deal(plans, block, per_shard, seed), "rank bigint, block bigint, shard bigint, slot bigint, limit bigint")
    # size estimates do not see that rows were multiplied, so the join's kind is named
    joined = segments.join(slots.hint("merge"), ["rank", "block"])
    taken = F.least(F.col("words"), F.col("limit") - F.col("offset"))
    pieces = joined.select("key", "digest", "row", "shard", "slot", F.col("offset").alias("at"), "first", taken.alias("words")).where("words > 0")
    return placed.select("key", "row", "size", "source_size", "target"), pieces


def _slots(p: dict, block: int) -> tuple[int, int]:
    """Slots that a source fills and words of its last one, so that it gives its target's words."""
    want, blocks, last = round(p["target"]), p["blocks"], p["source_size"] - (p["blocks"] - 1) * block
    if want <= 0 or blocks <= 0:
        return 0, 0
    epochs, rest = divmod(want, p["source_size"])
    if not rest:
        return epochs * blocks, block
    # In the epoch that the target ends in, where does the short block come?
    short = _find(blocks, p["seed"] + epochs)
    words = lambda s: s * block - (block - last if short < s else 0)  # noqa: E731  words of the first s slots
    s = max(1, math.ceil(rest / block))
    while words(s) < rest:
        s += 1
    return epochs * blocks + s, rest - words(s - 1)


def _find(n: int, key: int) -> int:
    """The k with permute(k) = n - 1, by walking the inverse network."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    if 1 << (2 * half) < n:
        half += 1
    mask, x, wrap = (1 << half) - 1, n - 1, (1 << 64) - 1
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(4)):
            z = (left + key + 0x9E3779B97F4A7C15 * (r + 1)) & wrap
            z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & wrap
            z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & wrap
            left, right = right ^ ((z ^ (z >> 31)) & mask), left
        x = (left << half) | right
        if x < n:
            return x


def words_taken(sizes: DataFrame, pieces: DataFrame) -> DataFrame:
    """``sizes`` with ``taken``: the words the mix takes of each document, repeats counted."""
    total = pieces.groupBy("key", "row").agg(F.sum("words").cast("bigint").alias("taken"))
    k, r = F.col("s.key").eqNullSafe(F.col("t.key")), F.col("s.row") == F.col("t.row")
    return sizes.alias("s").join(total.alias("t"), k & r, "left").select("s.*", F.coalesce("t.taken", F.lit(0)).alias("taken"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cut(text: pd.Series, pieces: pd.Series) -> pd.Series:
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")

    def one(t: str, parts) -> list[str]:
        found = [m.span() for m in word.finditer(t)]
        return [t[found[p["first"]][0] : found[p["first"] + p["words"] - 1][1]] for p in parts]

    return pd.Series([one(t, p) for t, p in zip(text, pieces, strict=True)], dtype=object)


def mixed_documents(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", n_chars: str = "n_chars", seed: int = 7, **how) -> DataFrame:
    """The mix as documents: one row per piece with ``df``'s columns; ``text`` is the stretch of
    the original text that the piece covers, ``n_chars`` (where there is such a column) its length.

    Rows are dealt by output shard and sorted by shard, slot and place in the slot: a written file
    holds whole shards, and the rows of a block of ``block`` words follow each other.

    Of rows with equal keys and texts all pieces are given with one row's other columns, the same in
    each run.  Null texts and texts without words are in no piece, null sources and keys are values
    like others, very long texts are cut like others, an empty table gives an empty one.
    """
    _, pieces = mix(df, text, source, key, seed=seed, **how)
    k, d, cuts, row, place = fresh(df.columns, "__key", "__digest", "__cuts", "__row", "__place")
    name = lambda c: F.coalesce(c.cast("string"), F.lit("\0"))
    piece = F.struct(F.col("first").cast("int").alias("first"), F.col("words").cast("int").alias("words"), "shard", "slot", "at")
    # a document's pieces are gathered, not its text repeated; there are as many as its own blocks
    cut = pieces.groupBy(name(F.col("key")).alias(k), F.col("digest").alias(d)).agg(F.collect_list(piece).alias(cuts))
    others = F.struct(*[df[c] for c in df.columns if c != text])
    whole = df.select(name(df[key]).alias(k), F.xxhash64(F.lit(seed), df[key], df[text]).alias(d), F.struct(*[df[c] for c in df.columns]).alias(row), F.xxhash64(F.to_json(others)).alias(place))
    whole = whole.groupBy(k, d).agg(F.max_by(row, place).alias(row))
    made = F.arrays_zip(_cut(F.col(row)[text], F.col(cuts)).alias("text"), F.transform(cuts, lambda c: F.struct(c["shard"], c["slot"], c["at"])).alias("place"))
    out = whole.join(cut, [k, d]).select(*[F.col(row)[c].alias(c) for c in df.columns if c != text], F.explode(made).alias(place))
    out = out.withColumn(text, F.col(place)["text"]).withColumn(place, F.col(place)["place"])
    if n_chars in df.columns:
        out = out.withColumn(n_chars, F.length(text).cast(df.schema[n_chars].dataType))
    out = out.repartition(F.col(place)["shard"]).sortWithinPartitions(place)
    return out.select(*df.columns)
