"""Streams with state against batch results and plain loops, with restarts."""

import time

import numpy as np
from pyspark.sql import functions as F

from quern.streaming import state

TEXTS = "conv bigint, turn bigint, text string, finish string"


def parts(spark, path, batches, schema):
    """Writes each batch as one file, in order of time."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))
        time.sleep(0.05)


def said(spark, source, out, **options):
    stream = spark.readStream.schema(TEXTS).option("maxFilesPerTrigger", 1).json(str(source))
    rows = state.drained(state.deltas(stream, "conv", "turn", "text", F.col("finish"), **options), str(out)).collect()
    return sorted((r["conv"], r["turn"], r["kind"], r["delta"], r["finish_reason"]) for r in rows if r["finish_reason"] is None) + sorted((r["conv"], r["turn"], r["kind"], r["delta"], r["finish_reason"]) for r in rows if r["finish_reason"] is not None)


def test_deltas_over_batches_and_a_restart(spark, tmp_path):
    first = [[(1, 0, "He", None), (1, 1, "Hello", None), (2, 0, "x", None)], [(2, 1, "x", None), (1, 2, "Hello you", None), (3, 0, None, None)]]
    parts(spark, tmp_path / "in", first, TEXTS)
    want = [(1, 0, "delta", "He", None), (1, 1, "delta", "llo", None), (1, 2, "delta", " you", None), (2, 0, "delta", "x", None), (2, 1, "delta", "", None)]
    assert said(spark, tmp_path / "in", tmp_path / "out") == want
    # another run goes on from the state; a closed key says nothing more
    parts(spark, tmp_path / "in", [[(1, 3, "Hello you!", "stop"), (1, 4, "Hello you! More", None)], [(1, 5, "late", None)]], TEXTS)
    more = said(spark, tmp_path / "in", tmp_path / "out")
    assert more == sorted([*want, (1, 3, "delta", "!", None), (1, 3, state.DONE, "", None)]) + [(1, 3, "finish", "", "stop")]


def test_budget_closes_a_key(spark, tmp_path):
    grown = [[(1, i, " ".join(f"w{j}" for j in range(i + 1)), None)] for i in range(6)]
    parts(spark, tmp_path / "in", grown, TEXTS)
    rows = said(spark, tmp_path / "in", tmp_path / "out", budget=4)
    # each turn adds a word: the running total is 4 at turn 3
    assert [r[1] for r in rows if r[2] == "delta"] == [0, 1, 2, 3] and rows[-1] == (1, 4, state.DONE, "", "budget")


def test_idle_keys_are_closed(spark, tmp_path):
    parts(spark, tmp_path / "in", [[(1, 0, "a", None)]], TEXTS)
    stream = spark.readStream.schema(TEXTS).json(str(tmp_path / "in"))
    made = state.deltas(stream, "conv", "turn", "text", F.col("finish"), idle_ms=1)
    query = made.writeStream.format("memory").queryName("idle").outputMode("append").start()
    try:
        # such a query has a batch after the other, so it is never through
        for _ in range(80):
            if spark.table("idle").where("kind <> 'delta'").count():
                break
            time.sleep(0.5)
        assert {(r["kind"], r["finish_reason"]) for r in spark.table("idle").collect()} == {("delta", None), (state.DONE, "idle")}
    finally:
        query.stop()


def near_rows(seed, n, dim=16):
    """Rows of which each tenth is a near copy of an earlier one: (id, copied id or None, vector)."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        old = out[rng.integers(0, len(out))] if out and i % 10 == 9 else None
        v = (np.array(old[2]) + rng.normal(size=dim) * 0.03 if old else rng.normal(size=dim)).astype(float)
        v /= np.linalg.norm(v)
        out.append((i, old[0] if old else None, [float(x) for x in v]))
    return out


def test_near_rows_are_dropped_across_batches_and_restarts(spark, tmp_path):
    schema = "id bigint, source bigint, v array<double>"
    rows = near_rows(3, 240)

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        query = state.append_unless_near(stream, str(tmp_path / "out"), str(tmp_path / "state"), 0.1, "id", "v", 16)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return {r["id"]: r for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()}

    parts(spark, tmp_path / "in", [rows[:80], rows[80:160]], schema)
    go()
    parts(spark, tmp_path / "in", [[*rows[160:], (1000, None, None)]], schema)
    kept = go()
    # the sequential pass: a row goes if a kept one is within the threshold
    want, held = set(), []
    for i, _, v in rows:
        if not any(((np.array(v) - w) ** 2).sum() <= 0.1 for w in held):
            want.add(i)
            held.append(np.array(v))
    assert want <= set(kept) and 1000 in kept and kept[0]["v"] == rows[0][2]
    near = {r[0] for r in rows} - want
    missed = near & set(kept)
    assert len(near) >= 20 and len(missed) <= 0.1 * len(near)
