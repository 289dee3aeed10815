import collections
import math

import numpy as np
from pyspark.sql import functions as F

from quern.llm import langid as L

from .helpers import clashing, docs, empty

EN = "the house of the lord is in the middle of that long and winding road and it was there when they came".split()
DE = "das haus des herrn ist in der mitte von dem langen weg und es war schon da als sie kamen".split()


def _train_rows(n=40):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(EN if i % 2 else DE, 30)), "en" if i % 2 else "de", "s", 0) for i in range(n)]
    return rows + [(900, None, "en", "s", 0), (901, "no label here", None, "s", 0)]


def plain(rows, longest=5):
    """Scores of a word per language from plain counts of all words and n-grams."""
    words, grams = {}, {}
    for _, text, lang, *_ in rows:
        if text is None or lang is None:
            continue
        own = words.setdefault(lang, collections.Counter())
        own.update(L.words_of(text))
    for lang, own in words.items():
        for w, n in own.items():
            padded = f" {w} "
            for size in range(1, longest + 1):
                for at in range(len(w) if size == 1 else len(padded) - size + 1):
                    gram = w[at] if size == 1 else padded[at : at + size]
                    grams.setdefault(lang, {}).setdefault(size, collections.Counter())[gram] += n

    def log(count, unit):
        return math.log((count[unit] + 0.5) / (sum(count.values()) + 0.5 * (len(count) + 1)))

    def score(word):
        if any(word in c for c in words.values()):
            return [log(words[k], word) for k in sorted(words)]
        for size in range(longest, 0, -1):
            found = [g for g in L.grams_of(word, size) if any(g in grams[k].get(size, {}) for k in words)]
            if found:
                return [sum(log(grams[k].get(size, collections.Counter()), g) for g in found) / len(found) for k in sorted(words)]
        return [0.0] * len(words)

    return score


def test_scores_are_those_of_plain_counts(spark):
    rows = [*_train_rows(), (902, "ein kleiner Satz, the, ß", "fr", "s", 0)]
    m = L.train(docs(spark, rows), "text", "lang")
    assert m["langs"] == ["de", "en", "fr"]
    scored, score = L._Scored(m), plain(rows)
    texts = [["the"], ["houses"], ["qqq"], ["weglange", "the", "zzz", "ß"], ["kleine", "e", "日本"], ["herrns"]]
    totals, known = scored.totals(texts)
    assert np.allclose(totals, [np.sum([score(w) for w in t], axis=0) for t in texts], atol=1e-4)
    have = {g for _, t, lang, *_ in rows if t and lang for w in L.words_of(t) for n in (4, 5) for g in L.grams_of(w, n)}
    words = {w for _, t, lang, *_ in rows if t and lang for w in L.words_of(t)}

    def is_known(w):
        shares = [sum(g in have for g in L.grams_of(w, n)) / len(L.grams_of(w, n)) for n in (4, 5) if L.grams_of(w, n)]
        return w in words or any(x >= 0.8 for x in shares)

    assert known.tolist() == [sum(map(is_known, t)) / len(t) for t in texts]
    assert scored.totals([["kleinen"], ["househouse"], ["kommen"], ["lang"]])[1].tolist() == [is_known("kleinen"), is_known("househouse"), is_known("kommen"), is_known("lang")]
    assert totals[1].argmax() == 1 and totals[5].argmax() == 0


def test_capacity_keeps_the_most_frequent_units_of_all_languages(spark):
    assert L.least_kept({1: 50, 2: 20, 9: 5}, 25) == 2 and L.least_kept({1: 50, 2: 20, 9: 5}, 24) == 9
    assert L.least_kept({1: 50}, 100) == 1 and L.least_kept({}, 5) == 1 and L.least_kept({3: 9}, 2) == 4
    rows = [(0, "aa aa aa bb bb cc", "en", "s", 0), (1, "aa dd dd", "de", "s", 0)]
    m = L.train(docs(spark, rows), "text", "lang", most_entries=4)
    # aa (4, two languages), bb and dd (2 each) fit; cc does not
    assert sorted(m["words"][0]) == sorted(L._digests(["aa", "bb", "dd"])) and len(m["words"][2]) == 4


def test_forgetting_changes_nothing(spark):
    m = L.train(docs(spark, _train_rows()), "text", "lang")
    small, large = L._Scored(m), L._Scored(m)
    small.most = 2
    for t in (["aa", "bb", "cc"], ["dd", "aa", "the"], ["the", "ee"], ["aa", "bb", "ff"]):
        assert np.allclose(small.totals([t])[0], large.totals([t])[0])


def test_predictions(spark):
    m = L.train(docs(spark, _train_rows()), "text", "lang")
    rows = [(1, "The Lord came", None, None, 0), (2, "Das HAUS war da", "en", "x", 0), (3, None, "en", "x", 0), (4, "123 -- _ ½", "en", "x", 0), (5, "", "en", "x", 0)]
    got = {r["doc_id"]: r for r in L.predict(clashing(docs(spark, [*rows, (6, "the house " * 50_000, None, None, 0), (6, "the house", None, None, 0)]), "__text"), F.col("text"), m, [F.col("doc_id"), F.col("__text")]).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] > 0.5


def test_edges(spark):
    m = L.train(empty(spark), "text", "lang")
    assert m["langs"] == []
    assert {r["lang_pred"] for r in L.predict(docs(spark), F.col("text"), m, [F.col("doc_id")]).collect()} == {"und"}
    m = L.train(docs(spark), "text", "lang")
    out = L.predict(docs(spark), F.col("text"), m, [F.col("doc_id")]).collect()
    assert len(out) == 8 and {r["lang_pred"] for r in out if r["doc_id"] == 6} == {"la"}
    assert L.predict(empty(spark), F.col("text"), m, [F.col("doc_id")]).count() == 0
    assert L.words_of("²½ x² ¼") == ["x²"] or L.words_of("²½ x² ¼") == ["x"]


def test_held_out_accuracy(spark):
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    m = L.train(docs_.where(~held), "text", "lang")
    out = L.predict(docs_.where(held), F.col("text"), m, [F.col("lang")])
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 250 and right > 0.98
