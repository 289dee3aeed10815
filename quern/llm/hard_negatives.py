"""Hard negatives by product quantisation with rigorous bounds.

Vectors of whole numbers are cut into parts, and each part is replaced by the nearest of 256 centroids; the
lengths of what is left over are stored beside the codes.  For an anchor a, a table of its products
with all centroids gives an approximate score of a row by look-ups, and the true score differs from it by the
sum over the parts of |a's part| times the stored length at most.  Rows whose bounds show that they cannot be among the
first are passed over; the exact product of whole numbers decides among all others.  So the result is exact,
whatever the centroids are; these are fitted on a bounded sample and only decide how much is passed over.

Rows are packed in blocks; every block of anchors meets every block of rows in one cell of a grid
that grows with the number of blocks, and gives the first few rows of each anchor.  Windows over these
complete the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .workspace import release, small_batches, stage

ROWS, ANCHORS = 1024, 256  # rows of a block
CODES = 256
#: Blocks of rows and of anchors that a cell of the grid holds, in a large table.
CELL_ROWS, CELL_ANCHORS = 64, 64


def whole_numbers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, as double; null for a null vector and where a component is
    null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def fit(sample: np.ndarray, width: int, rounds: int = 4) -> list[np.ndarray]:
    """Centroids of each part of ``width`` components: (codes, width) arrays, by k-means from rows of the sample."""
    draw, out = np.random.default_rng(0), []
    for at in range(0, sample.shape[1], width):
        x = sample[:, at : at + width].astype(np.float64)
        seen = np.unique(x, axis=0)
        c = seen[draw.permutation(len(seen))[:CODES]]
        for _ in range(rounds):
            near = _nearest(x, c)
            size = np.bincount(near, minlength=len(c))
            total = np.stack([np.bincount(near, x[:, i], len(c)) for i in range(x.shape[1])], 1)
            c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        out.append(c)
    return out


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None] - 2 * x @ c.T, axis=1)


def encode(v: np.ndarray, book: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths of the residuals), a column for each part."""
    codes, rest, at = [], [], 0
    for c in book:
        x = v[:, at : at + c.shape[1]].astype(np.float64)
        near = _nearest(x, c)
        codes.append(near)
        rest.append(np.sqrt(((x - c[near]) ** 2).sum(1)))
        at += c.shape[1]
    return np.stack(codes, 1).astype(np.uint8), np.stack(rest, 1)


def bounds(anchors: np.ndarray, codes: np.ndarray, rest: np.ndarray, lengths: np.ndarray, book: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of each anchor with each row, rounding errors allowed for."""
    score = np.zeros((len(anchors), len(codes)))
    sizes, at = [], 0
    for m, c in enumerate(book):
        a = anchors[:, at : at + c.shape[1]].astype(np.float64)
        score += (a @ c.T)[:, codes[:, m]]
        sizes.append(np.sqrt((a * a).sum(1)))
        at += c.shape[1]
    sizes = np.stack(sizes, 1)
    off = sizes @ rest.T + 1e-9 * np.sqrt((sizes * sizes).sum(1))[:, None] * lengths[None] + 1e-6
    return score - off, score + off


def exact(v: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Products of the rows of ``v`` with ``a``, in whole numbers."""
    most = float(np.abs(v).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(len(a), 1)
    if most < 2.0**62:
        return v @ a
    return v.astype(object) @ a.astype(object)  # fails later if a score itself is no long


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def first_positives(anchor, low, high, block, k: int):
    """Indexes and scores of the first ``k`` other rows of the anchor's label in a block."""
    id, label, v, _ = anchor
    ok = (block["labels"] == label) & (block["ids"] != id)
    if np.count_nonzero(ok) > k:
        ok &= high >= np.partition(low[ok], -k)[-k]
    at = np.flatnonzero(ok)
    scores = exact(block["ints"][at], v)
    order = _first(block["ids"][at], scores, k)
    return at[order], scores[order], len(at)


def first_negatives(anchor, low, high, block, k: int, share: tuple[int, int]):
    """For each positive of the anchor, the first ``k`` rows of other labels inside its window."""
    _, label, v, positives = anchor
    other = block["labels"] != label
    maybe = np.zeros(len(other), bool)
    for _, p in positives:
        if p < 0:
            continue  # its window is empty
        ok = other & (100 * high >= share[0] * p) & (100 * low <= share[1] * p)
        sure = other & (100 * low >= share[0] * p) & (100 * high <= share[1] * p)
        if np.count_nonzero(sure) >= k:
            ok &= high >= np.partition(low[sure], -k)[-k]
        maybe |= ok
    at = np.flatnonzero(maybe)
    scores = exact(block["ints"][at], v)
    out = []
    for id, p in positives:
        inside = np.flatnonzero((100 * scores >= share[0] * p) & (100 * scores <= share[1] * p))
        order = inside[_first(block["ids"][at[inside]], scores[inside], k)]
        out.append((id, p, at[order], scores[order]))
    return out, len(at)


def _matrix(vectors, dim: int) -> np.ndarray:
    """Rows of the same length; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def _block(batch, r: int, dim: int, parts: int) -> dict:
    held = {n: np.frombuffer(batch.column(n)[r].as_py(), t) for n, t in (("ids", np.int64), ("labels", np.int64), ("ints", np.int64), ("codes", np.uint8), ("rest", np.float64), ("lengths", np.float64))}
    n = len(held["ids"])
    return held | {"ints": held["ints"].reshape(n, dim), "codes": held["codes"].reshape(n, parts), "rest": held["rest"].reshape(n, parts)}


def mine(df: DataFrame, id: str, label: str | Column, vector: str | Column, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, share: tuple[int, int] = (30, 90), sample: int = 4096, width: int = 2) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all but rank long.

    vector: an array of whole numbers (``whole_numbers``); a score is the product with the anchor.  Higher
    scores come first, ties by the smaller id.  An anchor's positives are its first ``n_positives`` other
    rows of the same label; for each, the first ``n_negatives`` rows of other labels with a score of
    share[0] to share[1] per cent of the positive's.  A positive below zero has an empty window.

    Rows with a null id, label or vector take no part.  Rows with the same id count as one, the least by
    label, then vector.  Shorter vectors count as filled up with zeros.  A score must fit in a long.
    Empty tables, and tables without anchors, give an empty result; other columns are not looked at.
    ``sample`` bounds the rows that the centroids are fitted on (picked by a hash of the id, at the driver).
    """
    spark = df.sparkSession
    small_batches(spark)
    col = lambda c: df[c] if isinstance(c, str) else c
    given = df.select(col(id).cast("bigint").alias("id"), col(label).cast("bigint").alias("label"), col(vector).cast("array<bigint>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = stage(given.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("x")).select("id", "x.*"), "vectors")
    total, dim, asking = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("anchor")).first()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not asking or not dim:
        return spark.createDataFrame([], out)

    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30))).select("v").limit(sample)
    held = _matrix([x.as_py() for x in picked.toArrow().column(0)] or [[0]], dim)
    book = fit(held, width)
    parts = len(book)

    n_blocks, n_asking = -(-total // ROWS), -(-asking // ANCHORS)
    strips = min(n_blocks, max(-(-n_blocks // CELL_ROWS), 2 * spark.sparkContext.defaultParallelism))
    columns = -(-n_asking // CELL_ANCHORS)

    def pack(t: pa.Table) -> pa.Table:
        v = _matrix(t.column("v").to_pylist(), dim)
        codes, rest = encode(v, book)
        lengths = np.sqrt((v.astype(np.float64) ** 2).sum(1))
        arrays = [t.column("id").to_numpy(), t.column("label").to_numpy(), v, codes, rest, lengths]
        return pa.table([pa.array([t.column("b")[0].as_py()], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays]], names=["b", "ids", "labels", "ints", "codes", "rest", "lengths"])

    fields = "ids binary, labels binary, ints binary, codes binary, rest binary, lengths binary"
    blocks = rows.select("id", "label", "v", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("b"))
    blocks = stage(blocks.groupBy("b").applyInArrow(pack, f"b int, {fields}"), "vector-blocks")

    def pack_anchors(t: pa.Table) -> pa.Table:
        v = _matrix(t.column("v").to_pylist(), dim)
        arrays = [t.column("id").to_numpy(), t.column("label").to_numpy(), v]
        held = [[{"id": p["id"], "score": p["score"]} for p in ps or []] for ps in t.column("positives").to_pylist()]
        kind = pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))
        return pa.table([pa.array([t.column("b")[0].as_py()], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays], pa.array([held], kind)], names=["a", "a_ids", "a_labels", "a_ints", "positives"])

    def met(anchors: DataFrame, work, schema: str) -> DataFrame:
        numbered = anchors.withColumn("b", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(n_asking)).cast("int"))
        asked = numbered.groupBy("b").applyInArrow(pack_anchors, "a int, a_ids binary, a_labels binary, a_ints binary, positives array<array<struct<id:bigint,score:bigint>>>")
        left = asked.select("*", F.pmod("a", F.lit(columns)).alias("column"), F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip")).drop("a")
        right = blocks.select("*", F.pmod("b", F.lit(strips)).alias("strip"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column")).drop("b")
        names = [x.split()[0] for x in schema.split(", ")]

        def run(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    block = _block(batch, r, dim, parts)
                    ids, labels = (np.frombuffer(batch.column(n)[r].as_py(), np.int64) for n in ("a_ids", "a_labels"))
                    v = np.frombuffer(batch.column("a_ints")[r].as_py(), np.int64).reshape(len(ids), dim)
                    low, high = bounds(v, block["codes"], block["rest"], block["lengths"], book)
                    found = []
                    for i, positives in enumerate(batch.column("positives")[r].as_py()):
                        found += work((ids[i], labels[i], v[i], [(p["id"], p["score"]) for p in positives]), low[i], high[i], block)
                    yield pa.RecordBatch.from_arrays([pa.array([int(x[c]) for x in found], pa.int64()) for c in range(len(names))], names=names)

        return left.join(right, ["strip", "column"]).mapInArrow(run, schema)

    def positives_of(anchor, low, high, block):
        at, scores, _ = first_positives(anchor, low, high, block, n_positives)
        return [(anchor[0], block["ids"][j], s) for j, s in zip(at, scores, strict=True)]

    def negatives_of(anchor, low, high, block):
        found, _ = first_negatives(anchor, low, high, block, n_negatives, share)
        return [(anchor[0], p, score, block["ids"][j], s) for p, score, at, scores in found for j, s in zip(at, scores, strict=True)]

    asking_rows = rows.where("anchor").select("id", "label", "v")
    none = F.array().cast("array<struct<id:bigint,score:bigint>>")
    near = met(asking_rows.withColumn("positives", none), positives_of, "anchor bigint, id bigint, score bigint")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= n_positives)
    lists = near.groupBy("anchor").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    with_lists = stage(asking_rows.join(lists, F.col("id") == F.col("anchor")).drop("anchor"), "anchors")
    hard = met(with_lists, negatives_of, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_negatives)
    done = stage(ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "hard-negatives")
    release(rows, blocks, with_lists)
    return done
