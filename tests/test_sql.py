"""SQL table functions against the operators they stand for."""

import random

import pytest

from quern import sql
from quern.operators import parsers

PIECES = ["TSK 1. ", "\nTSK 2. ", "\nTSK 33.  ", "QUESTION:", " ANSWER: ", "CONTEXT: ", "CONTEXTUALANSWER:", "PROMPT:", "DESCRIPTION: ", "GUIDE:", "SETTING: ", "EXPERIENCE:", "it's \\d", "\n", "  ", "\u00a0x", "two words", "é", "\t"]
SAME = {
    "parse_tasks": lambda df: parsers.tasks(df, "text"),
    "parse_tasks_strict": lambda df: parsers.tasks(df, "text", strict=True),
    "parse_qa": lambda df: parsers.inline_qa(df, "text"),
    "parse_prompts": lambda df: parsers.inline_qa(df, "text", "PROMPT"),
    "parse_descriptions": lambda df: parsers.inline_qa(df, "text", "DESCRIPTION", "GUIDE"),
    "parse_questions": lambda df: parsers.questions(df, "text"),
    "parse_awareness": lambda df: parsers.awareness(df, "text").drop("category"),
    "parse_experience": lambda df: parsers.experience(df, "text"),
}


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choices(PIECES, k=r.randint(1, 14)))) for i in range(400)] + [(400, None), (401, "")]
    rows += [(402, "QUESTION: q\nCONTEXT: c\nANSWER: a\nCONTEXTUALANSWER: x"), (403, "SETTING: s\nEXPERIENCE: e"), (404, "DESCRIPTION: d GUIDE: g")]
    return spark.createDataFrame(rows, "id int, text string").cache()


def test_names_and_functions(spark):
    assert sorted(sql.register(spark)) == sorted(SAME)


@pytest.mark.parametrize("name", sorted(SAME))
def test_function_equals_operator(spark, texts, name):
    sql.register(spark)
    want = SAME[name](texts)
    got = spark.sql(f"SELECT t.id, p.* FROM {{t}} AS t, LATERAL {name}(t.text) AS p", t=texts)
    assert set(got.columns) == set(want.columns)
    key = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert key(got) == key(want) and got.count() > 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
