import os
import random

import numpy as np
import pyarrow as pa

from quern.llm import near_dup as N
from quern.llm.components import components

from .helpers import clashing, docs, empty


def brute(rows, width, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return sorted((i, len(s), root(i)) for i, s in sets)


def _cloud(seed, bases=6, copies=30):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(bases):
        base = rng.choices(vocab, k=rng.choice([3, 12, 60, 200]))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 6) + 1)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else "  ".join(w))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_same_as_brute_force(spark):
    for width, seed in ((2, 1), (5, 2), (2, 3)):
        rows = _cloud(seed) + [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, " \n"), (905, "one two"), (906, "a b c d e"), (907, "a b c d e f")]
        df = docs(spark, [(i, t, "en", "s", 0) for i, t in rows])
        got = sorted((r["id"], r["n_shingles"], r["component"]) for r in N.classes(df, width=width).collect())
        assert got == brute(rows, width)


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(N, "CELLS", 2000)
    rows = _cloud(9, bases=1, copies=150)
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = sorted((r["id"], r["n_shingles"], r["component"]) for r in N.classes(df, width=2).collect())
    assert got == brute(rows, 2)


def test_every_link_near_the_threshold_is_found(spark):
    # pairs of 60 words with 2 to 6 of them replaced: each pair is a class of its own if it is linked
    rng = random.Random(11)
    rows = []
    for p in range(2500):
        base = [f"p{p}w{i}" for i in range(60)]
        other = list(base)
        for i in rng.sample(range(60), rng.randint(2, 6)):
            other[i] = f"p{p}x{i}"
        rows += [(2 * p, " ".join(base)), (2 * p + 1, " ".join(other))]
    pairs = [brute(rows[i : i + 2], 2) for i in range(0, len(rows), 2)]
    linked = sum(p[0][2] == p[1][2] for p in pairs)
    assert 900 < linked < 2400
    got = sorted((r["id"], r["n_shingles"], r["component"]) for r in N.classes(docs(spark, [(i, t, "en", "s", 0) for i, t in rows]), width=2).collect())
    assert got == sorted(x for p in pairs for x in p)


def _block(sets, components=None, outside=None):
    sigs = N.signatures(sets)
    rows = [{"node": i, "component": i if components is None else components[i], "outside": True if outside is None else outside[i], "sig": sigs[i].tobytes(), "set": s.tobytes()} for i, s in enumerate(sets)]
    kind = pa.struct([("node", pa.int64()), ("component", pa.int64()), ("outside", pa.bool_()), ("sig", pa.binary()), ("set", pa.binary())])
    return N._Block(pa.array([None, *rows], kind)[1:])


def test_a_block_gives_a_forest_of_its_links():
    rng = random.Random(3)
    shingler = N.Shingler(2)
    sets = [shingler.set_of(shingler.split(t)) for _, t in _cloud(7, bases=2, copies=40)]
    linked = {(i, j) for j in range(80) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    block = _block(sets)

    def classes(pairs):
        up = list(range(80))
        for a, b in pairs:
            p, q = up[a], up[b]
            up = [min(p, q) if x in (p, q) else x for x in up]
        return up

    found = N.forest(block, block, N.least_matches(0.8), 80)
    assert set(found) <= linked and classes(found) == classes(linked)
    assert len(found) == 80 - len(set(classes(linked)))
    outside = [rng.random() < 0.3 for _ in sets]
    some = _block(sets, outside=outside)
    found = N.forest(some, some, N.least_matches(0.8), 80)
    assert classes(found) == classes((a, b) for a, b in linked if outside[a] or outside[b])


def test_texts_of_one_id_are_told_apart(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (1, None), (2, "U v  w x y z"), (0, "A b c\td e f"), (3, "a b c d e f")]
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = sorted((r["id"], r["n_shingles"], r["component"]) for r in N.classes(df).collect())
    assert got == [(0, 2, 0), (1, 0, 1), (1, 2, 0), (1, 2, 1), (2, 2, 1), (3, 2, 0)]
    kept = sorted((r["doc_id"], r["text"] or "") for r in N.keep_first(df).collect())
    assert kept == [(0, "A b c\td e f"), (1, ""), (1, "u v w x y z")]


def test_digests_agree(spark):
    texts = ["", " ", "One  TWO\n", "äÖ É\x0b x", "a\x0c\r b\x1cc", "\x00 x", "one two"]
    df = docs(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])
    s = N.Shingler(2)
    assert [r[0] for r in df.orderBy("doc_id").select(N.text_key(df["text"])).collect()] == [N.key_of(s.split(t)) for t in texts]


def test_nothing_is_left_behind_but_the_result(spark):
    from quern.llm.workspace import clear, shared_dir

    clear(spark)
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in _cloud(5, bases=2)])
    N.classes(df, width=2).collect()
    left = os.listdir(shared_dir(spark).removeprefix("file://"))
    assert len(left) == 1 and left[0].startswith("near-classes")


def test_edges(spark):
    df = clashing(docs(spark), "id", "key", "n", "bucket", "a", "b", "component")
    got = N.classes(df).collect()
    assert len(got) == 8
    by = {r["id"]: r for r in got}
    assert by[1]["component"] == 1 and by[2]["n_shingles"] == 0 and by[2]["component"] == 2 and by[None]["component"] is None
    assert sorted(str(r["doc_id"]) for r in N.keep_first(df).collect()) == sorted(["1", "1", "2", "3", "4", "None", "6", "7"])
    assert N.classes(empty(spark)).count() == 0 and N.keep_first(empty(spark)).count() == 0


def test_bounds():
    least = N.least_matches(0.8)
    assert least[180] < 144 and all(a <= b for a, b in zip(least.values(), list(least.values())[1:], strict=False))
    assert N.least_matches(0.8, miss=0.01)[180] > least[180]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1064)] + [(5, 5)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        p, q = root(a), root(b)
        up[max(p, q)] = min(p, q)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: root(i) for i in got} and len(got) == len({x for e in edges if e[0] != e[1] for x in e})
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
