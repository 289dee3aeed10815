import json

import pytest
from pyspark.sql import functions as F

from quern import cli
from quern.functions.vector import embedder
from quern.plans import categories, generate
from quern.sources import config, jsonl, responder
from quern.streaming import append as streaming


def _write(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(path)


def test_instructions(spark, tmp_path):
    p = _write(tmp_path / "a.jsonl", [{"instruction": "i", "response": "r", "category": "c"}, {"instruction": "j"}, "{bad", {"instruction": "k", "category": "reasoning_or_math", "extra": 1}])
    assert sorted(r["category"] for r in jsonl.read_instructions(spark, p).collect()) == ["c", "general", "reasoning_or_math"]
    assert jsonl.read_instructions(spark, p, keep_corrupt=True).where("_corrupt is not null").count() == 1
    assert sorted(r["category"] for r in jsonl.read_for_culling(spark, [p, p]).collect()).count("orca") == 2
    assert sorted(r["category"] for r in jsonl.read_categorised(spark, p).collect()) == ["c", "reasoning_or_math"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(" i ", "r\n", "c", None, None, True)], "instruction string, response string, category string, system string, skip_prompt_formatting boolean, skip_counting boolean")
    out = str(tmp_path / "o")
    jsonl.write_instructions(df, out)
    with pytest.raises(Exception, match="(?i)exists"):
        jsonl.write_instructions(df, out)
    jsonl.append_instructions(df, out)
    rows = spark.read.json(out).collect()
    assert len(rows) == 2 and rows[0].asDict() == {"instruction": "i", "response": "r", "category": "c"}
    jsonl.write_instructions(df, out, overwrite=True)
    assert spark.read.json(out).count() == 1
    jsonl.write_cards(spark.createDataFrame([("A", "d", "s"), ("A", "e", "s")], "name string, description string, stay_in_character string"), str(tmp_path / "cards"))
    assert spark.read.json(str(tmp_path / "cards")).count() == 1


def test_topics_seeds_and_routing(spark, tmp_path):
    assert sorted((r["topic_idx"], r["topic"]) for r in jsonl.read_topics(spark, _write(tmp_path / "t.txt", [" a ", "a", "", "b"])).collect()) == [(0, "a"), (1, "b")]
    with pytest.raises(ValueError):
        jsonl.read_topics(spark, _write(tmp_path / "e.txt", ["", " "]))
    d = tmp_path / "r"
    d.mkdir()
    _write(d / "expert_code.jsonl", [{"instruction": str(i)} for i in range(9)])
    _write(d / "expert_qa.jsonl", [{"instruction": "x"}])
    _write(d / "other.jsonl", [{"instruction": "x"}])
    got = {r["expert"]: r["count"] for r in jsonl.read_routing(spark, str(d), 5).groupBy("expert").count().collect()}
    assert got == {"code": 5, "qa": 1}
    s = tmp_path / "s"
    s.mkdir()
    for i in (0, 1):
        (s / f"{i}.txt").write_text(f"seed\n{i}")
    assert [r["seed"] for r in jsonl.read_seeds(spark, str(s)).orderBy("seed_idx").collect()] == ["seed\n0", "seed\n1"]


def test_config(spark):
    raw = {"default_count": 7, "min_docsearch_score": 0, "instructors": {"a": {"count": 0, "batch_size": None}, "b": {"min_docsearch_score": 0.02, "flesch": 40, "other": 1}, "c": None}}
    got = {r["category"]: r for r in config.categories(spark, raw).collect()}
    assert (got["a"]["count"], got["a"]["batch_size"], got["a"]["min_score"]) == (0, 5, 0.35)
    assert (got["b"]["count"], got["b"]["min_score"], got["b"]["flesch"]) == (7, 0.02, "40") and got["c"]["language"] == "English"
    assert config.api_params({"api_params": {"temperature": 0}})["temperature"] == 1.0 and config.flag("True") and not config.flag(None)


class Flaky:
    """Fails so many times, then answers."""

    def __init__(self, times):
        self.times, self.tried = times, 0

    def __call__(self, prompt):
        self.tried += 1
        if self.tried <= self.times:
            raise ConnectionError
        return f"after {self.times}"


def no_wait(seconds):
    return None


def test_responders(spark):
    table = spark.createDataFrame([("p1", "ok", "stop"), ("p2", "As an AI", "stop"), ("p3", "cut", "length")], "p string, text string, finish_reason string").withColumn("prompt_hash", F.md5("p"))
    df = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "instruction string")
    got = {r["instruction"]: r["response"] for r in responder.TableResponder(table).respond(df, F.col("instruction")).collect()}
    assert got == {"p1": "ok", "p2": None, "p3": None, "p4": None}
    f = responder.FunctionResponder(lambda p: {"p1": " x ", "p2": "flesch"}[p], missing=(KeyError,))
    got = {r["instruction"]: r["response"] for r in f.respond(df, F.col("instruction"), strip=True).collect()}
    assert got == {"p1": "x", "p2": None, "p3": None, "p4": None}
    assert responder.FunctionResponder(Flaky(2), attempts=3, wait=no_wait).respond(df.limit(1), F.col("instruction")).first()["response"] == "after 2"
    assert responder.FunctionResponder(Flaky(3), attempts=3, wait=no_wait).respond(df.limit(1), F.col("instruction")).first()["response"] is None
    with pytest.raises(Exception, match="KeyError"):
        responder.FunctionResponder(lambda p: {}[p]).respond(df, F.col("instruction")).collect()
    assert responder.backoff_seconds() == [1, 1, 2, 3, 5, 8, 13, 19]


def test_a_round_of_generation(spark):
    topics = spark.createDataFrame([(0, "a"), (1, 'b "q"'), (2, "c")], "topic_idx int, topic string")
    prompts = generate.topic_prompts("Make {batch_size}:\n{topics}", topics, 3, spark.range(2).withColumnRenamed("id", "batch"), 2)
    got = {r["batch"]: r["prompt"] for r in prompts.collect()}
    assert got[0] == 'Make 2:\n * TSK 1 must be related to topic: "a"\n * TSK 2 must be related to topic: "b \\"q\\""'
    assert '"c"' in got[1] and '"a"' in got[1]
    answers = spark.createDataFrame([(1, "TSK 1. write about the old house\nTSK 2. write about the old houses\nTSK 3. explain gravity")], "doc bigint, text string")
    rows = generate.parsed(answers, "tasks").withColumn("rid", F.col("pos").cast("bigint"))
    embed = embedder(64)
    history = spark.createDataFrame([(100, "explain gravity")], "rid bigint, t string").select("rid", embed("t").alias("__v"))
    assert [r["instruction"] for r in generate.accept(rows, history, embed, 0.2, "rid", True).collect()] == ["write about the old house"]
    assert generate.accept(rows, history, embed, 0.2, "rid", False).count() == 2
    done = generate.respond(rows, responder.FunctionResponder(lambda p: None if "gravity" in p else f" {p} "), "Do: {instruction}")
    assert sorted(r["response"] for r in done.collect())[0] == "Do: write about the old house"


def test_categories(spark):
    assert len(categories.CATEGORIES) == 26
    phases = categories.order_of_phases(["editor", "writing", "gtkm", "character", "nonsense"])
    assert phases == [["writing", "character"], ["editor", "gtkm"]]
    for c in categories.CATEGORIES.values():
        assert c.grammar in categories.GRAMMARS
    df = spark.createDataFrame([("starts with 'b'", "apple"), ("starts with 'a'", "apple 'a'")], "instruction string, response string")
    assert [r["system"] is not None for r in categories.finish(df, "trivia").collect()] == [True]
    cards = spark.createDataFrame([(0, "x"), (1, "y")], "card_idx int, card string")
    assert categories.stylised_pairs(spark.range(40), cards, 2, "id").count() == 40
    assert categories.writing_styles(["s1"], 12) == categories.writing_styles(["s1", "s2"], 3) == ["- TSK 1: in the style of s1"]
    assert categories.writing_styles(["s1", "s2"], 1) == [] and len(categories.writing_styles(["a", "b", "c"], 12)) == 3


def test_streams(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    _write(src / "1.json", [{"instruction": " a ", "response": "b", "category": "c"}, {"instruction": " a ", "response": "b", "category": "c"}])
    stream = streaming.exact_once(streaming.read_stream(spark, str(src)), ["instruction"])
    streaming.append(stream, str(out), str(tmp_path / "cp")).awaitTermination()
    assert [r["instruction"] for r in spark.read.json(str(out)).collect()] == ["a"]
    _write(src / "2.json", [{"instruction": " a ", "response": "z", "category": "c"}, {"instruction": "new", "response": "z", "category": "c"}])
    stream = streaming.exact_once(streaming.read_stream(spark, str(src)), ["instruction"])
    streaming.append(stream, str(out), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["instruction"] for r in spark.read.json(str(out)).collect()) == ["a", "new"]


def test_near_stream(spark, tmp_path):
    src, hist = tmp_path / "in", str(tmp_path / "hist")
    src.mkdir()
    schema = "id bigint, v array<double>"
    _write(src / "1.json", [{"id": 1, "v": [1.0, 0.0]}, {"id": 2, "v": [1.0, 0.01]}, {"id": 3, "v": [0.0, 1.0]}])

    def run():
        s = spark.readStream.schema(schema).json(str(src))
        streaming.append_unless_similar(s, hist, str(tmp_path / "cp"), 0.1, "id", "v").awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(hist).collect())

    assert run() == [1, 3]
    _write(src / "2.json", [{"id": 4, "v": [0.0, 1.0]}, {"id": 5, "v": [-1.0, 0.0]}])
    assert run() == [1, 3, 5]


def test_lines_for_culling_are_numbered_in_order(spark, tmp_path):
    for name, lines in (("b", range(40, 60)), ("a", range(40))):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"instruction": f"i{i}", "response": "r", "category": "rp"}) + "\n" for i in lines))
    with open(tmp_path / "c.jsonl", "w") as f:
        f.write('\n{"instruction": "i0", "response": "r", "category": "rp"}\nbroken\n' * 2)
    rows = jsonl.read_for_culling(spark, str(tmp_path / "*.jsonl"), numbered=True).orderBy("rid").collect()
    assert [r["instruction"] for r in rows if r["instruction"]][:60] == [f"i{i}" for i in range(60)]
    assert len({r["rid"] for r in rows}) == len(rows) and sum(r["instruction"] == "i0" for r in rows) == 3
    out = str(tmp_path / "out")
    cli.main(["cull", "--input", str(tmp_path / "*.jsonl"), "--output", out])
    # categories that pass through keep repeated lines
    assert spark.read.json(out).where("instruction = 'i0'").count() == 3
