"""Every category that is made from one kind of prompt, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from quern import cli
from quern.plans import categories, run
from quern.sources import jsonl
from quern.sources.responder import ExpressionResponder

ANSWERS = {
    "tasks": "TSK 1. Do it\nTSK 2. Do that too",
    "tasks_strict": "TSK 1. Do it\nTSK 2. Do that too",
    "question": "QUESTION: What is yes or no?\nANSWER: yes",
    "prompt": "PROMPT: What is yes?\nANSWER: yes",
    "description": "DESCRIPTION: NAME: Ann\nOf old\nGUIDE: Stay",
    "awareness": "QUESTION: Where?\nCONTEXT: Here\nANSWER: no\nCONTEXTUALANSWER: yes",
    "experience": "SETTING: A room\nEXPERIENCE: It was dark",
    "context": "BEGININPUT\nBEGINCONTEXT\nENDCONTEXT\nx\nENDINPUT\nBEGININSTRUCTION\nWhy?\nENDINSTRUCTION",
}
ONE_PROMPT = sorted(n for n, c in categories.CATEGORIES.items() if c.grammar in cli.ONE_PROMPT)


def prompts(spark, n=2):
    return spark.createDataFrame([(i, "Make") for i in range(n)], "batch bigint, prompt string")


@pytest.mark.parametrize("name", ONE_PROMPT)
def test_category_gives_stored_rows(spark, name):
    made = ANSWERS[categories.CATEGORIES[name].grammar]
    model = ExpressionResponder(lambda p: F.when(p == "Make", made).otherwise(F.concat(F.lit("As asked: "), p)))
    embed = lambda c: F.array(F.length(c).cast("double"))
    rows = run.run(name, prompts(spark), model, embed=embed).collect()
    assert rows and all(r["category"] == name and r["instruction"].strip() and r["response"].strip() and r["rid"] is not None for r in rows)


def test_coding_marks_and_keeps_code(spark):
    asked = lambda p: F.contains(p, F.lit(categories.CODE_ONLY))
    model = ExpressionResponder(lambda p: F.when(p == "Make", "TSK 1. Code\nTSK 2. More code").when(asked(p), "Sure\n```py\nx = 1\n```").otherwise("See ```x```"))
    rows = run.run("coding", prompts(spark, 40), model).collect()
    plain = [r for r in rows if r["instruction"].endswith(" PLAINFORMAT")]
    assert 20 < len(plain) < 60 and len(rows) == 80
    assert all(r["response"] == "x = 1" for r in plain) and all(r["response"] == "See ```x```" for r in rows if r not in plain)


def test_trivia_with_details(spark):
    model = ExpressionResponder(lambda p: F.when(p == "Make", "QUESTION: What?\nANSWER: It").otherwise(F.concat(F.lit("More: "), p)))
    rows = run.run("trivia", prompts(spark, 40), model, detailed=0.5).collect()
    more = [r for r in rows if r["system"] is None]
    assert len(rows) - len(more) == 40 and 8 < len(more) < 32
    assert all(r["instruction"] == "What?" + run.DETAIL and r["response"] == "More: What?" + run.DETAIL and r["category"] == "trivia" for r in more)


def test_cards_of_characters_become_files(spark, tmp_path):
    model = ExpressionResponder(lambda p: F.concat(F.lit("DESCRIPTION: NAME: Ann\nOf old "), F.col("batch").cast("string"), F.lit("\nGUIDE: Stay")))
    cards = run.characters(prompts(spark, 3), model)
    jsonl.write_cards(cards, str(tmp_path / "cards"))
    (held,) = jsonl.read_cards(spark, str(tmp_path / "cards/*")).collect()
    assert (held["name"], held["description"], held["stay_in_character"]) == ("Ann", "Of old 0", "Stay")
    assert len([f for f in tmp_path.rglob("*.json")]) == 1 and json.loads(next(tmp_path.rglob("*.json")).read_text())["name"] == "Ann"


def test_awareness_kinds_and_no_cards(spark):
    model = ExpressionResponder(lambda p: F.when(F.startswith(p, F.lit("who ")), F.concat(F.lit("QUESTION: Who?\nANSWER: Me\nCONTEXTUALANSWER: As "), F.substr(p, F.lit(5)), F.lit(", I"))).otherwise(ANSWERS["awareness"]))
    templates = {"location": "where", "temporal": "when", "character": "who {name}"}
    cards = spark.createDataFrame([(0, "Ann", "Of old"), (1, "Bo", "an AI, it says")], "card_idx bigint, name string, description string")
    batches = spark.range(60).select(F.col("id").alias("batch"))
    rows = run.awareness(batches, cards, model, templates, ["Eve"]).collect()
    chats = [r for r in rows if r["skip_prompt_formatting"]]
    assert len(rows) == 120 and 24 <= len(chats) <= 48 and all(r["response"] == "I" and "Eve: Who?" in r["instruction"] for r in chats)
    assert all(r["system"] == "A chat. Here" for r in rows if r["variant"] == 1 and r not in chats)
    # the first of equal questions stays, with both its rows
    alike = run.awareness(batches, cards, model, templates, ["Eve"], embed=lambda c: F.array(F.length(c).cast("double"))).collect()
    assert len(alike) == 4
    none = run.awareness(batches, cards.limit(0), model, templates, ["Eve"]).collect()
    assert len(none) == 120 - 2 * len(chats)
