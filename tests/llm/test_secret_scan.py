import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import secret_scan as S

from .helpers import clashing, docs, empty


@pytest.fixture(scope="module")
def ratios(spark):
    return S.train(S.training_samples(spark, rows=2000))


def plain(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def test_base_spans_as_plain_search(spark, ratios):
    rng = random.Random(5)
    bits = ["password", "token=", "token=secret=", "API_KEY", "apikey: '", '" = "', "AKIA", "AKIAAKIA", "🙂", "é", "\n", " ", "deadbeef" * 2, "0123456789abcde", "ABCDEFGHIJKLMN12", "=", ":", "abcdefghijkl", "x.y_z-12345678", "passwd"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 14))) for _ in range(400)] + [" ".join(["cafe" * 5, "token=abcdefghijkl99"] * 300)]
    df = docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    for r in S.scan(df, "text", ratios).collect():
        got = [(s["start"], s["kind"], s["end"]) for s in r["secrets"]]
        assert [x for x in got if x[1] < 3] == plain(r["text"]), r["text"]
        assert got == sorted(got)


def test_models_tell_random_from_ordinary(spark, ratios):
    rng = random.Random(1)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secrets = ["".join(rng.choices(alphabet, k=32)) for _ in range(200)] + [hashlib.md5(bytes([i])).hexdigest() for i in range(100)]
    words = ["getCurrentUserSessionManager", "/usr/share/lib/python/site-packages", "user_account_balance_total_amount", "internationalization-and-localization", "thonherenteaningthatertion"]
    df = docs(spark, [(i, f"see {t} there", "en", "s", 0) for i, t in enumerate(secrets + words)])
    found = {r["doc_id"]: [s for s in r["secrets"] if s["kind"] == 3] for r in S.scan(df, "text", ratios).collect()}
    hit = sum(bool(found[i]) for i in range(len(secrets)))
    assert hit >= 0.97 * len(secrets)
    assert not any(found[len(secrets) + i] for i in range(len(words)))
    assert all((s["start"], s["end"]) == (4, 4 + len(secrets[i])) for i in range(len(secrets)) for s in found[i])


def flagged(tokens, ratios, threshold=9.0, stretch=11.0):
    """The share of tokens that the models call random, the plain way."""
    at, n, out = S.ALPHABET.index, len(S.ALPHABET), 0
    for t in tokens:
        total = now = best = 0.0
        for a, b in zip(t, t[1:], strict=False):
            x = ratios[at(a) * n + at(b)]
            total, now = total + x, max(now + x, 0.0)
            best = max(best, now)
        out += total >= threshold or best >= stretch
    return out / len(tokens)


@pytest.fixture(scope="module")
def production(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return S.train(S.training_samples(spark, rows))


def test_names_of_public_sources_are_no_secrets(production):
    import glob
    import os
    import string

    import pyspark

    texts = [open(f, errors="ignore").read() for f in glob.glob(os.path.dirname(pyspark.__file__) + "/**/*.py", recursive=True)]
    names = sorted({x for t in texts for x in re.findall(r"\b[A-Za-z_][A-Za-z0-9_]{19,}\b", t)})
    constants = [x for x in names if x.upper() == x]
    assert len(names) > 3000 and len(constants) > 200
    assert flagged(names, production) <= 0.01
    assert flagged([x.upper() for x in names], production) <= 0.02 and flagged(constants, production) <= 0.01
    assert flagged([x.replace("_", "-") for x in names], production) <= 0.01
    r = random.Random(4)
    assert flagged(["".join(r.choices(string.digits, k=20)) for _ in range(300)], production) == 0
    for alphabet in (string.ascii_letters + string.digits, string.ascii_uppercase + "234567", "0123456789ABCDEF", string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits):
        assert flagged(["".join(r.choices(alphabet, k=r.randint(20, 40))) for _ in range(400)], production) >= 0.97


def test_held_out_documents(spark, production):
    """Words of documents that were not sampled: none is a secret, but those that a base span touches."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = S.scan(rows, "text", production).where(F.size("secrets") > 0).select("text", "secrets").collect()
    spans = [(r["text"][s["start"] : s["end"]], any(o["kind"] < 3 and o["start"] < s["end"] and s["start"] < o["end"] for o in r["secrets"])) for r in out for s in r["secrets"] if s["kind"] == 3]
    assert len(spans) > 100
    alone = [t for t, touched in spans if not touched]
    assert len(alone) <= 0.02 * len(spans), alone


def test_names_and_paths_do_not_hide_secrets(spark):
    ratios = S.train(S.training_samples(spark))  # as the query
    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    names = ["client_identifier=", "database_connection_string=", "storage_account_access_value=", "/usr/share/lib/data/", "connection_string_value_"]
    runs = [n + "".join(rng.choices(alphabet, k=k)) + end for n in names for k in (16, 32) for end in ("", "/document") for _ in range(20)]
    plain_ = [n + "default_user_name" for n in names]
    df = docs(spark, [(i, f"see {t} there", "en", "s", 0) for i, t in enumerate(runs + plain_)])
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["secrets"] if s["kind"] == 3] for r in S.scan(df, "text", ratios).collect()}
    assert sum(found[i] == [(4, 4 + len(t))] for i, t in enumerate(runs)) >= 0.95 * len(runs)
    assert not any(found[len(runs) + i] for i in range(len(plain_)))


def test_best_stretch(spark, ratios):
    at, n = S.ALPHABET.index, len(S.ALPHABET)
    for token in ("aB3_x9-Zq", "the_name=xQ9zK2/and", "a", "ordinary"):
        x = [ratios[at(a) * n + at(b)] for a, b in zip(token, token[1:], strict=False)]
        want = max([0.0] + [sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)])
        if len(token) > 1:
            assert spark.range(1).select(S.best_stretch(F.lit(token), ratios)).first()[0] == pytest.approx(want, abs=1e-6)


def test_score_is_the_sum_of_transitions(spark, ratios):
    token, at = "aB3_x9-Zq", S.ALPHABET.index
    want = sum(ratios[at(a) * len(S.ALPHABET) + at(b)] for a, b in zip(token, token[1:], strict=False))
    got = spark.range(1).select(S.log_likelihood_ratio(F.lit(token), ratios)).first()[0]
    assert got == pytest.approx(want, abs=1e-6)


def test_edges(spark, ratios):
    df = clashing(docs(spark), "secrets", "spans")
    rows = S.scan(df, "text", ratios).collect()
    assert len(rows) == 8 and all(r["secrets"] == [] for r in rows)
    assert S.scan(empty(spark), "text", ratios).count() == 0
    assert S.train(spark.createDataFrame([(None, "abc"), ("random", None), ("ordinary", "é🙂")], "label string, sample string")) == pytest.approx([0.0] * 67**2)


def test_plan_is_native(spark, ratios):
    plan = S.scan(docs(spark), "text", ratios)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
