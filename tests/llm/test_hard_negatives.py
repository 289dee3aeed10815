"""Hard negatives against all products; the bounds against exact scores."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quern.llm import hard_negatives, queries

from .helpers import clashing

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    held = {}
    for id, x, label in rows:
        if id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if id % 7 == 0 else label
        v = [math.floor(256 * float(np.float32(c))) for c in x]
        held[id] = min(held.get(id, (label, v)), (label, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, v) in held.items():
        if a % 100:
            continue
        scores = sorted((-dot(v, w), b, other) for b, (other, w) in held.items() if b != a)
        for p in [x for x in scores if x[2] == label][:5]:
            window = [x for x in scores if x[2] != label and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]][:10]
            out += [(a, p[1], n + 1, x[1], -p[0], -x[0]) for n, x in enumerate(window)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def query(spark, tmp_path, rows, name="embeddings", clash=()):
    clashing(spark.createDataFrame(rows, SCHEMA), *clash).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    return got(queries.op11_hard_negatives(spark, f"{tmp_path}/{name}"))


def test_ties_nulls_repeats_and_uneven_lengths(spark, tmp_path):
    r = random.Random(2)
    few = [0.0, 0.25, 0.5, -0.25, 1.0]
    rows = [(i, [r.choice(few) for _ in range(5 if i % 9 else 3)], r.choice([1, 2, 2, 2])) for i in range(0, 700, 5)]
    rows += [(None, [1.0], 1), (100, None, 1), (201, [1.0, None], 2), (203, [float("nan")], 2), (204, [float("inf"), 1.0], 2), (205, [1.0], None), (300, [0.5, 0.5], 1), (300, [0.5, 0.5], 1), (400, [1.0, 1.0, 1.0], 3), (7, [], 2)]
    want = plain(rows)
    assert len(want) > 50 and any(x[5] == 0 or x[4] == 0 for x in want)
    assert query(spark, tmp_path, rows) == want
    assert query(spark, tmp_path, rows, "clash", ["id", "v", "anchor", "score", "b"]) == want


def test_blocks_and_a_hot_label(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "CELL_ANCHORS", 1)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(900, 12)).round(3)
    rows = [(i * 4, [float(c) for c in v], int(min(k, 3))) for i, (v, k) in enumerate(zip(x, draw.integers(0, 10, 900), strict=True))]
    assert query(spark, tmp_path, rows) == plain(rows)


def test_empty_tables(spark, tmp_path):
    assert query(spark, tmp_path, []) == []
    assert query(spark, tmp_path, [(1, [1.0], 1), (2, [1.0], 2)], "no-anchor") == []
    assert query(spark, tmp_path, [(100, [], 1), (200, [], 1)], "no-components") == []


def test_bounds_hold_and_pass_over_rows():
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    v = np.floor(256 * np.stack(t["embedding"]).astype(np.float64)).astype(np.int64)
    labels, ids = t["label"].to_numpy().astype(np.int64), t["vec_id"].to_numpy().astype(np.int64)
    book = hard_negatives.fit(v[::2], 2)
    codes, rest = hard_negatives.encode(v, book)
    block = {"ids": ids, "labels": labels, "ints": v, "codes": codes, "rest": rest}
    low, high = hard_negatives.bounds(v[:40], codes, rest, np.sqrt((v.astype(float) ** 2).sum(1)), book)
    scores = v[:40] @ v.T
    assert (low <= scores).all() and (scores <= high).all()
    looked_at = sum(hard_negatives.first_positives((ids[i], labels[i], v[i], []), low[i], high[i], block, 5)[2] for i in range(40))
    assert looked_at < 0.5 * sum((labels == labels[i]).sum() for i in range(40))
    # products that only fit larger numbers
    big = np.array([[2**40, -(2**40)]])
    assert list(hard_negatives.exact(big, np.array([2**20, 2**20 - 1]))) == [2**40]


def test_whole_numbers(spark):
    rows = [([0.1, -0.001],), ([None],), (None,), ([float("-inf")],), ([],)]
    out = spark.createDataFrame(rows, "v array<float>").select(hard_negatives.whole_numbers(F.col("v")).alias("w")).collect()
    assert [r["w"] for r in out] == [[25, -1], None, None, None, []]
