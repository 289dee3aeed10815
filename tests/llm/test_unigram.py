import random

import pytest
from pyspark.sql import functions as F

from quern.llm import unigram as U

from .helpers import EDGE, clashing, docs, empty


@pytest.fixture(scope="module")
def vocabulary(spark):
    return U.default_vocabulary(spark)


def plain(word, v):
    """Fewest tokens among the best-scored splits."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        c = word[end - 1]
        if c not in v["pieces"]:
            n = len(c.encode())
            options.append((best[end - 1][0] + n * v["byte"], best[end - 1][1] + n))
        for at in range(end):
            s = v["pieces"].get(word[at:end])
            if s is not None:
                options.append((best[at][0] + s, best[at][1] + 1))
        top = max(s for s, _ in options)
        best.append((top, min(n for s, n in options if s == top)))
    return best[-1][1]


def test_shared_prefixes_change_nothing(vocabulary):
    rng = random.Random(2)
    small = {"pieces": {p: -rng.random() * 9 - 1 for p in ["a", "b", "c", "ab", "bc", "abc", "ca", "aab", "▁", "▁a", "cc"]}, "byte": -20.0}
    words = {"".join(rng.choices("abcdé▁", k=rng.randrange(1, 12))) for _ in range(800)}
    for v in (small, vocabulary):
        c = U.Counter(v)
        c.learn(words)
        assert all(c.known[w] == plain(w, v) for w in words)


def test_forgetting_changes_nothing(vocabulary):
    small, large = U.Counter(vocabulary, 3), U.Counter(vocabulary)
    texts = ["to be or not to be", "that is the question", None, "", "  two  spaces\n\nand lines\t", "日本語🙂"] * 2
    assert [small.count([t])[0] for t in texts] == large.count(texts)


def test_pre_tokens_keep_every_character():
    for t in ("a b", " a", "  x\n\ny ", "\t", "▁▁ z"):
        assert "".join(U.pre_tokens(t)) == "▁" + t.replace(" ", "▁")


def test_columns(spark, vocabulary):
    df = clashing(docs(spark), "n", "__text", "n_tokens")
    out = U.count_tokens(df, F.col("text"), vocabulary, [F.col(c) for c in df.columns])
    assert out.columns == [c for c in df.columns if c != "n_tokens"] + ["n_tokens"]
    rows = out.collect()
    assert len(rows) == len(EDGE) and {r["__text"] for r in rows} == {"x"}
    for r in rows:
        if r["doc_id"] != 6:
            assert r["n_tokens"] == sum(plain(w, vocabulary) for w in U.pre_tokens(r["text"] or ""))
        else:
            assert r["n_tokens"] > 50_000
    assert U.count_tokens(empty(spark), F.col("text"), vocabulary, [F.col("doc_id")]).count() == 0
    assert {r["n_docs"] for r in U.totals(U.count_tokens(docs(spark), F.col("text"), vocabulary, [F.col("source")]), "source").collect()} == {1, 2, 3}
