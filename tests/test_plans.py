"""Chats against a plain loop; knobs of contextual prompts; generating and culling in several runs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quern import cli
from quern.functions.vector import embedder
from quern.plans import categories, chat, run
from quern.plans.cull import cull, resumed
from quern.sources.responder import ExpressionResponder

CAST = "session bigint, topic string, cast array<struct<name:string,description:string,hint:string>>, first string"


class Script:
    """Answers from a list for each session, the n-th to the n-th call; null settings where it is empty."""

    def __init__(self, scripts):
        self.scripts, self.calls = scripts, 0

    def respond(self, df, prompt, out="response", filtered=True, strip=False):
        if "turns" not in df.columns:
            return df.withColumn(out, F.lit("A room."))
        at, self.calls = self.calls, self.calls + 1
        rows = F.create_map(*[x for k, v in self.scripts.items() for x in (F.lit(k), F.lit(v[at] if at < len(v) else None).cast("string"))])
        return df.withColumn(out, F.try_element_at(rows, F.col("session")))


def plain(cast, first, script, most):
    """What one chat must hold after its system turn: (role, text), or nothing."""
    user, turns, now, failed = cast[-1], [("user", "Begin.")], first, 0
    for answer in script:
        body, _, after = (answer or "").partition("\nNEXT: ")
        if not body.strip():
            if len(turns) == 1:
                return None
            if failed > chat.REROLLS:
                break
            failed += 1
            continue
        role = "user" if now == user and len(turns) > 1 else "assistant"
        line = f"{now}: {body}"
        if role == "assistant" == turns[-1][0]:
            turns[-1] = (role, turns[-1][1] + "\n\n" + line)
        else:
            turns.append((role, line))
        now = after
        if len(turns) + 1 >= most or (now == user and len(turns) + 1 >= most - 1):
            break
    return turns


def test_chats_as_a_plain_loop(spark):
    cast = ["Ann", "Bob", "Me"]
    scripts = {
        0: ["a\nNEXT: Bob", "b\nNEXT: Me", "c\nNEXT: Ann", "d\nNEXT: Ann", "e\nNEXT: Me", "f\nNEXT: Bob", "g\nNEXT: Me"],
        1: ["a\nNEXT: Me", None, "", "b\nNEXT: Ann", "c\nNEXT: Me", "d\nNEXT: Bob", "e\nNEXT: Me"],
        2: [None, "a\nNEXT: Me"],
        3: ["a\nNEXT: Me"] + [None] * 8,
    }
    rows = [(k, "tea", [(n, "d", "h") for n in cast], cast[k % 3]) for k in scripts]
    ended = chat.chats(spark.createDataFrame(rows, CAST), Script(scripts), "{topic}", "{name}{user}{others}{hint}", "{name}", ["Begin."], ["Go on."], 6)
    got = {r["session"]: [tuple(t) for t in r["turns"][1:]] for r in ended.collect()}
    want = {k: plain(cast, cast[k % 3], v, 6) for k, v in scripts.items()}
    assert got == {k: v for k, v in want.items() if v}
    assert chat.rows(ended).where("not skip_counting").count() == len(got)


def test_chats_without_the_user_end(spark):
    rows = [(0, "tea", [("Ann", "d", "h"), ("Bob", "d", "h"), ("Me", "d", "h")], "Ann")]
    answer = lambda p: F.concat(F.lit("x\nNEXT: "), F.when(F.col("current") == "Ann", "Bob").otherwise("Ann"))

    class Two(ExpressionResponder):
        def respond(self, df, prompt, **k):
            return super().respond(df, prompt, **k) if "turns" in df.columns else df.withColumn("setting", F.lit("s"))

    ended = chat.chats(spark.createDataFrame(rows, CAST), Two(answer), "{topic}", "{name}", "{name}", ["Begin."], ["Go."], 4, most_answers=3)
    assert ended.first()["turns"][2]["text"] == "Ann: x\n\nBob: x\n\nAnn: x"
    assert chat.chats(spark.createDataFrame([], CAST), Two(answer), "{topic}", "{name}", "{name}", ["B"], ["G"]).count() == 0


def test_contextual_prompts(spark):
    topics = spark.createDataFrame([(i, f'"{i}"') for i in range(7)], "topic_idx bigint, topic string")
    batches = spark.range(400).withColumnRenamed("id", "batch")
    template = "{input_count}|{task_count}|{metadata_counts}|{styles}|{format_task}|{reference_texts}|{topics}|{task_confounder}|{include_source}|{language}"
    wishes = run.Wishes(styles=("mail", "poem"), formats=("JSON", "CSV", "XML", "YAML"))
    rows = [r["prompt"].split("|") for r in run.contextual_prompts(template, batches, topics, 7, wishes, language="English").orderBy("batch").collect()]
    at = 0
    for n, tasks, metadata, styles, _, together, about, _, _, language in rows:
        n = int(n)
        assert 1 <= n <= 4 and 1 <= int(tasks) <= 3 and language == "English"
        assert len(metadata.split("\n")) == len(styles.split("\n")) == n
        assert about.split("\n") == [f" * text {i + 1} should be related to topic: " + json.dumps(f'"{(at + i) % 7}"') for i in range(n)]
        assert n > 1 or together == wishes.separate
        at += n
    share = lambda i: sum(bool(r[i]) for r in rows) / len(rows)
    assert 0.13 < share(4) < 0.27 and 0.05 < share(7) < 0.16 and 0.13 < share(8) < 0.27
    assert len({r[4] for r in rows}) > 3


def test_register():
    known = dict(categories.CATEGORIES), dict(categories.GRAMMARS)
    try:
        with pytest.raises(ValueError):
            categories.register("haiku", categories.Category("lines", False, 5, 1, None))
        categories.register("haiku", categories.Category("lines", False, 5, 1, None, after=("card",)), lambda df, t: df)
        assert categories.order_of_phases(["haiku", "card"]) == [["card"], ["haiku"]]
    finally:
        categories.CATEGORIES.clear(), categories.CATEGORIES.update(known[0])
        categories.GRAMMARS.clear(), categories.GRAMMARS.update(known[1])


def test_culling_goes_on(spark, tmp_path):
    embed = embedder()
    rows = spark.createDataFrame([(i, "general", f"Tell of number {i % 4} and its {'friends' * (i % 4)}", "x" * (i + 1)) for i in range(12)], "rid bigint, category string, instruction string, response string")
    rows = rows.withColumn("embedding", embed(F.col("instruction")))
    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    early = rows.where("rid < 8")
    assert resumed(early, 0.1, out, state) == 0
    first = {r["rid"] for r in spark.read.parquet(out).collect()}
    assert first == {r["rid"] for r in cull(early, 0.1).collect()} and len(first) < 8
    # a run without complete state is done again and replaces what it left
    (tmp_path / "state" / "run=0" / "_SUCCESS").unlink()
    assert resumed(early, 0.1, out, state) == 0
    assert resumed(rows, 0.1, out, state) == 1
    all_ = [r["rid"] for r in spark.read.parquet(out).collect()]
    assert len(all_) == len(set(all_)) and {r for r in all_ if r < 8} == first
    assert resumed(rows, 0.1, out, state) == 2
    assert spark.read.parquet(out).count() == len(all_)


def test_generating_verbs(spark, tmp_path, monkeypatch):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    write = lambda name, rows: (tmp_path / name).write_text("\n".join(map(json.dumps, rows)))
    write("prompts", [{"category": "orca", "batch": 0, "prompt": "ask"}, {"category": "song", "batch": 0, "prompt": "unconfigured"}])
    answers = [("ask", "QUESTION: One?\nANSWER: 1\nQUESTION: Two?\nANSWER: 2\nQUESTION: Three and more?\nANSWER: 3"), ("topics", "1. Cats\n2. cats \n3. Dogs")]
    write("answers", [{"prompt_hash": md5(p), "text": t, "finish_reason": "stop"} for p, t in answers])
    write("config", [{"instructors": {"orca": {"count": 2}, "song": {"count": 0}}}])
    write("topic_prompts", [{"batch": 0, "prompt": "topics"}])
    path = lambda name: f"{tmp_path}/{name}"
    monkeypatch.setattr(cli.config, "load", lambda p: json.loads(open(p).read()))
    cli.main(["generate-instructions", "--prompts", path("prompts"), "--answers", path("answers"), "--config", path("config"), "--output", path("out")])
    rows = spark.read.json(path("out")).collect()
    assert sorted((r["category"], r["instruction"], r["response"]) for r in rows) == [("orca", "One?", "1"), ("orca", "Two?", "2")]
    cli.main(["generate-instructions", "--prompts", path("prompts"), "--answers", path("answers"), "--config", path("config"), "--output", path("out")])
    assert spark.read.json(path("out")).count() == 2
    cli.main(["generate-topics", "--prompts", path("topic_prompts"), "--answers", path("answers"), "--output", path("topics")])
    assert sorted(r["value"] for r in spark.read.text(path("topics")).collect()) == ["Cats", "Dogs"]
