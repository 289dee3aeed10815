"""Spelling variants against a comparison of all pairs."""

import random
import zlib

from quern.llm import queries, variants

from .helpers import EDGE, clashing, docs, empty


def one_edit(a, b):
    """Whether exactly one character is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    forms, out = {}, {}
    for w, n in counts.items():
        close = sorted((-m, v) for v, m in counts.items() if one_edit(w, v))
        form = close[0][1] if close and -close[0][0] >= 10 * n else None
        forms[w] = form
        out[w] = [form, None, n, len(close), counts[form] if form else None]
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in rows}


def test_random_words(spark):
    r = random.Random(1)
    counts = {}
    for base in ("aaab", "abab", "éaba", "bbbb"):
        for _ in range(120):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(w))
                w[at : at + r.randint(0, 1)] = r.choice(["a", "b", "é", "", "aa"])
            if w := "".join(w):
                counts[w] = r.choice([2, 3, 20, 30, 200, 3000, 30000])
    assert got(variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))) == plain(counts)


def test_chain_ties_and_edges(spark):
    counts = {"abcdefgh": 2, "abcdefg": 20, "abcdefx": 20, "abcdeff": 200, "zzzzzzz": 5}
    rows = [*counts.items(), (None, 3), ("", 9)]
    found = got(variants.group_variants(clashing(spark.createDataFrame(rows, "word string, n bigint"), "root", "rest", "at")))
    assert found == plain(counts)
    # tie of abcdefg and abcdefx: the first by code point, then on to the most frequent one
    assert found["abcdefgh"][:2] == ("abcdefg", "abcdeff")
    assert got(variants.group_variants(spark.createDataFrame([], "word string, n bigint"))) == {}


def counted(rows):
    counts = {}
    for id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if n >= 2}


def test_query_on_whole_texts(spark, tmp_path):
    r = random.Random(5)
    words = ["Straßenbahn", "ÉCLAIRAGE", "international", "notation×mark", "national", "nationals", "sixsix", "exactly7", "Wörterbuch", "it's", "documentation"]
    rows = [(r.choice([i, 3, None]), " ".join(r.choice(words) + r.choice(["", ",", "-x", "\n"]) for _ in range(60)), None, None, None) for i in range(120)] + EDGE
    for name, df in (("some", docs(spark, rows)), ("clash", clashing(docs(spark, rows), "word", "n", "rest")), ("none", empty(spark))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    want = plain(counted([(x[0], x[1]) for x in rows]))
    assert any(v[0] for v in want.values())
    assert got(queries.op13_spelling_variants(spark, f"{tmp_path}/some")) == want
    assert got(queries.op13_spelling_variants(spark, f"{tmp_path}/clash")) == want
    assert got(queries.op13_spelling_variants(spark, f"{tmp_path}/none")) == {}


def test_no_pairs_of_a_group(spark):
    # 60 words of one group: 60 rows come out of the groups, not 60 * 59
    counts = spark.createDataFrame([("wor" + chr(0xC0 + i) + "ding", i + 2) for i in range(60)], "word string, n bigint")
    rows = variants.near(counts).collect()
    assert len(rows) == 60 and all(r["n_near"] == 59 for r in rows)
