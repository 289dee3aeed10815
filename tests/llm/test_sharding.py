from collections import Counter

import pytest

from quern.llm import sharding as S

from .helpers import clashing, docs, empty


def _slow_fill(names, size):
    import hashlib

    prefs = []
    for n in names:
        d = hashlib.sha256(n.encode()).digest()
        a, b = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        prefs.append([(a + j * b) % size for j in range(size)])
    table = {}
    while len(table) < size:
        for i, p in enumerate(prefs):
            if len(table) < size:
                table[next(s for s in p if s not in table)] = i
    return [table[s] for s in range(size)]


def test_table():
    names = [f"n{i}" for i in range(7)]
    assert S.fill_table(names, 251) == _slow_fill(names, 251)
    full = S.fill_table([f"n{i}" for i in range(64)])
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 64
    names = [f"n{i}" for i in range(64)]
    other = S.fill_table(names[:-1])
    moved = sum(names[a] != names[b] for a, b in zip(full, other, strict=True))
    assert moved < 3 * len(full) / 64
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            S.fill_table(bad)
    with pytest.raises(ValueError):
        S.fill_table(["a"], 100)


def test_place(spark):
    import hashlib

    names = [f"n{i}" for i in range(5)]
    table = S.fill_table(names)
    df = clashing(docs(spark), "slot", "SHARD", "__slot", "id", "code")
    got = S.place(df, "doc_id", names).collect()
    assert len(got) == 8
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) % S.TABLE_SIZE
        assert (r["slot"], r["shard"]) == (slot, names[table[slot]])
    assert S.place(empty(spark), "doc_id", names).count() == 0


def test_plan_is_native_and_without_shuffle(spark):
    plan = S.place(docs(spark), "doc_id", ["a", "b"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "hashpartitioning" not in plan
