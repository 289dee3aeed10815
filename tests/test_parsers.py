import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.operators import filters, parsers

BITS = ["TSK 1. ", "TSK 22.", "\nTSK 3.  ", "1. ", "\n2. ", "QUESTION:", "ANSWER:", "CONTEXT:", "CONTEXTUALANSWER:", "word", "é ", "\n", " ", "\r", "x:", "\t"]
TEXTS = st.lists(st.lists(st.sampled_from(BITS), max_size=14).map("".join), min_size=1, max_size=25)
# the same grammars, as plain regular expressions
PLAIN = {
    parsers.TOPICS: r"(?:^|\n)\d+\. (.*?)(?:$|(?=\n\d+\. ))",
    parsers.TASKS: r"(?:^|\n)TSK \d+\.\s*(.*?)(?:$|(?=\nTSK \d+\.\s*))",
    parsers.TASKS_STRICT: r"(?:^|\n)TSK \d+\. (.*?)(?:$|(?=\nTSK \d+\. ))",
    parsers.AWARENESS: r"QUESTION:(.*?)CONTEXT:(.*?)ANSWER:(.*?)CONTEXTUALANSWER:(.*?)(?=QUESTION|$)",
    parsers.AWARENESS_CHARACTER: r"QUESTION:(.*?)ANSWER:(.*?)CONTEXTUALANSWER:(.*?)(?=QUESTION|$)",
    parsers.QUESTIONS: r"QUESTION:(.*?)(?=QUESTION|$)",
    parsers.NUMBERED: r"(?:^|\n)(\d+)\. (.*?)(?:$|(?=\n\d+\. ))",
}


@given(TEXTS)
@settings(max_examples=12, deadline=None)
def test_matches_equal_findall(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for pattern, plain in PLAIN.items():
        groups = re.compile(plain).groups
        names = [f"g{j}" for j in range(groups)]
        got = df.select("i", parsers.all_matches("t", pattern, names).alias("m")).collect()
        for r in got:
            want = re.findall(plain, texts[r["i"]], re.DOTALL)
            want = [(w,) if groups == 1 else w for w in want]
            assert [tuple(m) for m in r["m"]] == want, (pattern, texts[r["i"]])


def _one(spark, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def test_inline_qa(spark):
    df = _one(spark, t="intro QUESTION: a ANSWER: b\nQUESTION:  \nANSWER: c QUESTION: d ANSWER: e ANSWER: f")
    assert [(r["instruction"], r["response"]) for r in parsers.inline_qa(df, "t").collect()] == [("a", "b"), ("d", "e ANSWER: f")]


def test_sections_once_per_number_and_last_wins(spark):
    t = "FACTS\n1. A [x: https://a] b\n2. no source\n3. C [https://c]\nCOUNTER\n1. N\n1. M\n3. O\nQUESTIONS\n1. Q\n3. R"
    got = sorted((r["number"], r["fact"], r["counter"], r["question"], r["source"]) for r in parsers.sections(_one(spark, i=1, t=t), "t").collect())
    assert got == [("1", "A  b", "M", "Q", "https://a"), ("3", "C ", "O", "R", "https://c")]
    rows = parsers.counterfactuals(parsers.sections(_one(spark, i=1, t=t), "t"), F.lit("why?")).collect()
    assert len(rows) == 4 and all(r["instruction"].startswith("BEGININPUT\nBEGINCONTEXT\nurl: https://") for r in rows)


def test_conversation(spark):
    said = lambda r: _one(spark, i="hello", r=r).select(parsers.conversation("i", "r").alias("c")).first()["c"]
    assert [(x["from"], x["value"]) for x in said("hi")] == [("human", "hello"), ("gpt", "hi")]
    assert [x["value"] for x in said("a</s> USER: b ASSISTANT: c \n</s>USER:d ASSISTANT:e")] == ["hello", "a", "b", "c", "d", "e"]
    assert said("a</s>b") is None and said("a</s>") is None


def test_plain_code(spark):
    code = lambda i, r: _one(spark, i=i, r=r).select(parsers.plain_code("i", "r").alias("c")).first()["c"]
    assert code("x PLAINFORMAT", "a\n```py\nx=1\n```\nb") == "x=1"
    assert code("x", "```py\nx\n```") == "```py\nx\n```" and code("PLAINFORMAT", "x") == "x"
    assert code("PLAINFORMAT", "```\n\n```") is None


def test_next_speaker(spark):
    def run(r, cur="Ann", delim=None):
        b, n = parsers.next_speaker(F.lit(r), F.lit(cur), F.lit("User"), F.array(*map(F.lit, ["Ann", "Bob", "Cleo"])), delim)
        return tuple(spark.range(1).select(b.alias("b"), n.alias("n")).first())

    assert run("Ann: hi “there”\nNEXT: Bob\n") == ('hi "there"', "Bob")
    assert run('hi\nBob: no\nNEXT: "Cleo"')[1] == "Cleo" and run("hi\nBob: no")[0] == "hi"
    assert run("hi REMINDER: x NEXT: Bob") == ("hi", "User")
    assert run("hi", cur="User")[1] in ("Ann", "Bob", "Cleo")
    assert run("hi\nNEXT: Bobb")[1] == "Bob"


def test_function_name(spark):
    f = lambda r: _one(spark, r=r).select(parsers.function_name("r", ["code", "a.b"]).alias("n")).first()["n"]
    assert f('{"FUNCTION":  "zzz"}') == "zzz" and f('use "Code"') == "Code" and f('"axb"') is None and f("none") is None


def test_experience_and_names(spark):
    r = parsers.experience(_one(spark, t="SETTING:\n room\n\nEXPERIENCE: long\ntale "), "t").first()
    assert (r["setting"], r["experience"]) == ("room", "long\ntale")
    n, d = parsers.named(F.lit("Tall. NAME: Ann Bee\nKind."))
    assert tuple(spark.range(1).select(n, d).first()) == ("Ann Bee", "Tall. Kind.")


def test_context_blocks(spark):
    ok = "BEGININPUT\nBEGINCONTEXT\na\nENDCONTEXT\nb\nENDINPUT\n"
    end = "BEGININSTRUCTION\nq\nENDINSTRUCTION"
    cases = {ok + end: True, ok * 2 + end + "\n\n": True, "\n " + ok + end: True, ok.replace("ENDINPUT", "") + end: False, end: False, ok + end + "x": False, ok.replace("b", "b" * 100_000) + end: True}
    for t, want in cases.items():
        assert _one(spark, t=t).select(filters.is_context_block("t")).first()[0] is want
        plain = r"^[\s\n]*(?:BEGININPUT[\s\n]+BEGINCONTEXT(?:.*?)ENDCONTEXT(?:.*?)ENDINPUT[\s\n]*)+BEGININSTRUCTION.*ENDINSTRUCTION[\s\r\n]*$"
        assert bool(re.match(plain, t, re.DOTALL)) is want
