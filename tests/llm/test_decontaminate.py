import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import decontaminate as D

from .helpers import clashing, docs, empty


def semi(p, t):
    """Least edit distance of p to any stretch of t, the plain way."""
    col = list(range(len(p) + 1))
    best = col[-1]
    for c in t:
        new = [0]
        for j, q in enumerate(p, 1):
            new.append(min(col[j] + 1, new[-1] + 1, col[j - 1] + (q != c)))
        col = new
        best = min(best, col[-1])
    return best


@given(st.text("abc", min_size=1, max_size=80), st.text("abcd", max_size=120))
@settings(max_examples=200, deadline=None)
def test_bit_parallel_distance(p, t):
    assert D.least_distance(D.masks_of(p), len(p), t)[0] == semi(p, t)


@given(st.text(min_size=1, max_size=60), st.integers(0, 70))
@settings(deadline=None)
def test_pieces(item, k):
    got = D.pieces_of(item, k)
    assert "".join(p for _, p in got) == item and all(item.startswith(p, a) and p for a, p in got)
    assert len(got) == min(k + 1, len(item))


def _edited(rng, text, n):
    t = list(text)
    for _ in range(n):
        i = rng.randrange(len(t))
        kind = rng.randrange(3)
        if kind == 0:
            t[i] = rng.choice("xyz")
        elif kind == 1:
            t.insert(i, rng.choice("xyz"))
        else:
            del t[i]
    return "".join(t)


def test_same_as_plain_search():
    rng = random.Random(7)
    items = [(i, "".join(rng.choices("abcdefgh ", k=rng.randrange(45, 160))).strip("ab ") + "zzq") for i in range(25)]
    finder = D.Finder(items, 0.06, 40)
    for _ in range(60):
        key, item = rng.choice(items)
        text = "".join(rng.choices("abcdefgh ", k=200)) + _edited(rng, item, rng.randrange(0, 14)) + "".join(rng.choices("abcdefgh ", k=200))
        want = []
        for i, t in items:
            n = D.normal(t)
            d = semi(n, D.normal(text))
            if d <= D.budget(n, 0.06):
                want.append((i, d))
        found = finder.find(text)
        assert [(i, d) for i, d, _, _ in found] == want
        by = dict(items)
        for i, d, start, end in found:
            assert whole(D.normal(by[i]), D.normal(text)[start:end]) == d


def whole(p, t):
    """Edit distance of two strings, the plain way."""
    row = list(range(len(t) + 1))
    for i, q in enumerate(p, 1):
        new = [i]
        for j, c in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (q != c)))
        row = new
    return row[-1]


def test_short_items_are_found_as_they_are_and_alone():
    finder = D.Finder([(1, "Too  short"), (2, ""), (3, "é 7")], 0.06, 40)
    find = lambda t: [(i, d, t[a:b]) for i, d, a, b in finder.find(t)]
    assert find("it is too short, no") == [(1, 0, "too short")] and find("too shor") == [] and find("stoo short too shorts") == []
    assert find("stoo short (too short)") == [(1, 0, "too short")] and find("é 7") == [(3, 0, "é 7")] and find("é 77") == []


def test_columns_blocks_and_edges(spark, monkeypatch):
    items = [(1, "what is the capital of the country where the river ends its way"), (1, "which of these numbers is the smallest prime that is not even at all"), (2, None), (None, "a null id is an item like every other one in the table of items"), (3, "too short")]
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(10, "x " + items[0][1].upper().replace(" ", "\n ") + " y", "en", "s", 0), (11, items[1][1].replace("prime", "prine"), "en", "s", 0), (12, "nothing here", "en", "s", 0), (13, items[3][1], "en", "s", 0), (14, "too short", "en", "s", 0), (15, None, "en", "s", 0), (16, items[3][1] + ". " + items[0][1], "en", "s", 0)]
    for most in (4_000_000, 10):
        monkeypatch.setattr(D, "BLOCK_BYTES", most)
        df = clashing(docs(spark, rows), "found", "__text", "item")
        got = {r["doc_id"]: [(x["item"], x["distance"]) for x in r["found"]] for r in D.contaminated(df, F.col("text"), b, [F.col("doc_id"), F.col("found"), F.col("__text")]).collect()}
        assert got == {10: [(1, 0)], 11: [(1, 1)], 12: [], 13: [(None, 0)], 14: [(3, 0)], 15: [], 16: [(1, 0), (None, 0)]}
    assert all(r["found"] == [] for r in D.contaminated(docs(spark), F.col("text"), b.limit(0), [F.col("doc_id")]).collect())
    assert D.contaminated(docs(spark), F.col("text"), b, [F.col("doc_id")]).count() == 8
    assert D.contaminated(empty(spark), F.col("text"), b, [F.col("doc_id")]).count() == 0
