import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import mixing as M

from .helpers import clashing, docs, empty


@given(st.integers(1, 5000), st.integers(0, 2**50))
@settings(max_examples=60, deadline=None)
def test_permutation(n, key):
    got = M.permute(np.arange(n), np.full(n, n), np.full(n, key))
    assert sorted(got.tolist()) == list(range(n))
    assert got[M._find(n, key)] == n - 1


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
@settings(deadline=None)
def test_water_fill(sizes):
    w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    t = M.water_fill(w, [2.0 * s for s in sizes], 1.5 * sum(sizes))
    assert sum(t) == pytest.approx(1.5 * sum(sizes)) and all(x <= 2 * s + 1e-9 for x, s in zip(t, sizes, strict=True))
    free = [x / v for x, v, s in zip(t, w, sizes, strict=True) if s and x < 2 * s - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


@given(st.lists(st.integers(0, 400), min_size=1, max_size=6), st.integers(1, 40), st.integers(0, 30), st.integers(0, 9))
@settings(max_examples=40, deadline=None)
def test_shards_are_drawn_alike_one_by_one_and_together(slots, per_shard, first, seed):
    counts = np.array(slots)
    every = list(M.shard_counts(counts, per_shard, 0, 10**9, seed))
    shards = -(-sum(slots) // per_shard)
    assert [s for s, *_ in every] == list(range(shards))
    before = np.zeros(len(slots), np.int64)
    for s, own, sofar in every:
        assert own.sum() == min(per_shard, sum(slots) - s * per_shard) and (sofar == before).all()
        before += own
    assert before.tolist() == slots
    for s in range(first, min(shards, first + 3)):
        ((_, own, sofar),) = M.shard_counts(counts, per_shard, s, s + 1, seed)
        assert (own == every[s][1]).all() and (sofar == every[s][2]).all()


def test_counts_vary_as_draws_without_replacement():
    # plain version: slots of three sources shuffled and cut into shards
    counts, per_shard = np.array([600, 300, 100]), 50
    rng = np.random.default_rng(1)
    plain, drawn = [], []
    for seed in range(150):
        deck = rng.permutation(np.repeat([0, 1, 2], counts))
        plain += [np.bincount(deck[i : i + per_shard], minlength=3) for i in range(0, 1000, per_shard)]
        drawn += [own for _, own, _ in M.shard_counts(counts, per_shard, 0, 20, seed)]
    plain, drawn = np.array(plain), np.array(drawn)
    assert np.allclose(drawn.mean(0), [30, 15, 5]) and np.allclose(drawn.std(0), plain.std(0), rtol=0.08)


def test_large_nodes_are_split_in_proportion(monkeypatch):
    monkeypatch.setattr(M, "MOST_DRAWN", 10)
    assert M.split_counts(np.array([7 * 10**11, 2 * 10**11, 10**11 + 1]), 5 * 10**11, 0).tolist() == [35 * 10**10, 10**11, 5 * 10**10]


def _rows(n=300, sources=7):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(int(rng.integers(0, 90)))), "en", None if i % sources == 0 else f"s{i % sources}" if i % 3 else "s1", 0) for i in range(n)]
    return [*rows, (1000, " ".join(["long"] * 5000), "en", "s2", 0), (1001, None, "en", None, 0), (1002, "", "en", "only empty", 0), (1003, "tiny", "en", "tiny", 0)]


def test_taken_meets_targets_and_pieces_are_real(spark):
    rows = _rows()
    sizes, pieces = M.mix(docs(spark, rows), block=16, per_shard=32)
    got = M.words_taken(sizes, pieces).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken, target, size = {}, {}, {}
    for r in got:
        s = source[r["key"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        size[s] = size.get(s, 0) + r["size"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in taken:
        assert abs(taken[s] - target[s]) <= 1, s
        assert target[s] <= 2 * size[s]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    p = pieces.collect()
    slots = {}
    for r in p:
        slots.setdefault((r["shard"], r["slot"]), []).append((r["at"], r["words"]))
    for parts in slots.values():  # blocks without gaps
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at <= 16
    counts = [k[0] for k in slots]
    assert max(counts) == (len(slots) - 1) // 32
    again = {(r["key"], str(r["row"])): r["taken"] for r in M.words_taken(*M.mix(docs(spark, rows).repartition(5), block=16, per_shard=32)).collect()}
    assert again == {(r["key"], str(r["row"])): r["taken"] for r in got}


def test_documents(spark):
    rows = _rows(60)
    df = docs(spark, rows)
    out = M.mixed_documents(df, block=16).collect()
    text = {r[0]: r[1] for r in rows}
    assert out[0].__fields__ == df.columns
    for r in out:
        assert r["text"] in text[r["doc_id"]] and r["n_chars"] == len(r["text"])
    sizes, pieces = M.mix(df, block=16)
    assert sum(len(r["text"].split()) for r in out) == pieces.groupBy().sum("words").first()[0]
    # rows of a block follow each other: in a partition, pieces come by shard, slot and place
    placed = {(r["key"], r["first"], r["words"], r["shard"], r["slot"], r["at"]) for r in pieces.collect()}
    parts = M.mixed_documents(df, block=16, per_shard=8).rdd.glom().collect()
    where = {}
    for r in M.mix(df, block=16, per_shard=8)[1].collect():
        words = text[r["key"]].split()[r["first"] : r["first"] + r["words"]]
        where.setdefault((r["key"], " ".join(words)), []).append((r["shard"], r["slot"], r["at"]))
    assert len(placed) == len(out)
    for part in parts:
        seen = [where[r["doc_id"], r["text"]] for r in part]
        last = (-1, -1, -1)
        for options in seen:
            last = min(o for o in options if o > last)


def test_repeated_rows_give_the_same_in_each_run(spark):
    rows = [(1, "a b c d e f", "en", "s", 0), (1, "a b c d e f", "de", "s", 0), (1, "a b c d e f", None, "s", 0), (2, "x y", "en", "t", 0)]
    runs = [sorted(map(str, M.mixed_documents(docs(spark, rows[::step]).repartition(n), block=4).collect())) for step, n in ((1, 1), (-1, 3))]
    assert runs[0] == runs[1] and len({r.split("lang=")[1].split(",")[0] for r in runs[0] if "doc_id=1" in r}) == 1


def test_edges(spark):
    df = clashing(docs(spark), "key", "size", "rank", "taken")
    sizes, pieces = M.mix(df)
    got = M.words_taken(sizes, pieces).collect()
    assert len(got) == 8 and all(r["taken"] <= 2 * r["size"] for r in got)
    assert sum(r["taken"] for r in got if r["key"] == 6) > 0
    assert set(M.mixed_documents(df).columns) == set(df.columns)
    sizes, pieces = M.mix(empty(spark))
    assert M.words_taken(sizes, pieces).count() == 0 and M.mixed_documents(empty(spark)).count() == 0
