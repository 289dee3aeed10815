"""Command line: ``python -m quern.cli VERB ...``; see ``--help``.

Generating verbs take prompts as JSONL (category, batch, prompt) and the answers of a model as JSONL
(prompt_hash: MD5 of the prompt, text, finish_reason); no model is called.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.vector import embedder
from .operators import parsers, routing, sampling
from .plans import categories, run
from .plans.cull import cull, resumed
from .sources import config, jsonl
from .sources.responder import TableResponder
from .storage import cut

# grammars whose rows come from one kind of prompt
ONE_PROMPT = ("tasks", "tasks_strict", "question", "prompt", "description", "awareness", "experience", "context")


def generate(spark: SparkSession, raw: dict, prompts, responder, output: str, embed=None) -> list[str]:
    """Appends rows of all configured categories that have prompts, phase by phase; rows that are
    there count towards a category's target and are compared with. Returns the categories."""
    wanted = {r["category"]: r for r in config.categories(spark, raw).where("count > 0").collect()}
    done = []
    for phase in categories.order_of_phases(wanted):
        for name in phase:
            c, own = categories.CATEGORIES[name], wanted[name]
            asked = prompts.where(F.col("category") == name).select("batch", "prompt")
            if c.grammar not in ONE_PROMPT or asked.isEmpty():
                continue
            try:
                before = jsonl.read_instructions(spark, output).where(F.col("category") == name)
                history = before.select(F.xxhash64("instruction").alias("rid"), embed(F.col("instruction")).alias("embedding")) if embed else None
                existing = before.groupBy("category").agg(F.count(F.lit(1)).alias("count"))
                existing.isEmpty()
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                history = existing = None
            template = ((raw.get("instructors") or {}).get(name) or {}).get("response_template")
            rows = run.run(name, asked, responder, history=history, embed=embed, template=template, target=own["count"], existing=existing, detailed=0.5 if name == "trivia" else 0.0, language=own["language"], flesch=own["flesch"] or "")
            # read before the folder it may come from is appended to
            jsonl.append_instructions(cut(rows.drop("batch", "rid", "pos")), output)
            done.append(name)
    return done


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quern")
    sub = p.add_subparsers(dest="verb", required=True)
    for verb in ("cull", "export", "split", "route"):
        s = sub.add_parser(verb)
        s.add_argument("--input", nargs="+", required=True)
        s.add_argument("--output", required=True)
        if verb == "cull":
            s.add_argument("--threshold", type=float, default=0.35)
            s.add_argument("--state", help="folder of keys that earlier runs have processed; the output is Parquet then")
        if verb == "split":
            s.add_argument("--experts", required=True, help="JSONL of expert, category")
        if verb == "route":
            s.add_argument("--routing", required=True)
            s.add_argument("--k", type=int, default=20)
            s.add_argument("--most", type=int, help="rows of each expert, by a hash; all by default")
    for verb in ("generate-topics", "generate-instructions"):
        s = sub.add_parser(verb)
        s.add_argument("--prompts", required=True)
        s.add_argument("--answers", required=True)
        s.add_argument("--output", required=True)
        if verb == "generate-instructions":
            s.add_argument("--config", required=True)
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("quern").getOrCreate()
    embed = embedder()
    if a.verb.startswith("generate"):
        prompts = spark.read.schema("category string, batch bigint, prompt string").json(a.prompts)
        model = TableResponder(spark.read.schema("prompt_hash string, text string, finish_reason string").json(a.answers))
        if a.verb == "generate-topics":
            jsonl.write_topics(run.topics(prompts.select("batch", "prompt"), model), a.output)
        else:
            generate(spark, config.load(a.config), prompts, model, a.output, embed)
    elif a.verb == "cull":
        embedded = lambda rows: rows.withColumn("embedding", embed(F.concat("instruction", F.lit("\n"), "response")))
        if a.state:
            # what runs have processed is known by its text, whatever files it comes in
            rows = jsonl.read_for_culling(spark, a.input).withColumn("rid", F.xxhash64("line")).dropDuplicates(["rid"])
            resumed(embedded(rows), a.threshold, a.output, a.state)
        else:
            rows = embedded(jsonl.read_for_culling(spark, a.input, numbered=True))
            jsonl.write_instructions(cull(rows, a.threshold).drop("rid", "embedding", "line"), a.output)
    elif a.verb == "export":
        rows = jsonl.read_instructions(spark, a.input).select(parsers.conversation("instruction", "response").alias("conversations"))
        jsonl.write_conversations(rows.where("conversations is not null"), a.output)
    elif a.verb == "split":
        rows = jsonl.read_categorised(spark, a.input).withColumn("rid", F.xxhash64("category", "instruction", "response"))
        experts = spark.read.schema("expert string, category string").json(a.experts)
        split = sampling.expert_split(rows, experts, "category", "rid", seed=0).drop("rid")
        own = split.where("own").select("expert", routing.routing_text("system", "instruction").alias("instruction"))
        jsonl.write_expert_split(split.drop("own"), own, a.output)
    else:
        table = jsonl.read_routing(spark, a.routing, a.most).withColumn("rid", F.xxhash64("expert", "instruction")).withColumn("embedding", embed("instruction"))
        asked = jsonl.read_instructions(spark, a.input).withColumn("rid", F.xxhash64("instruction")).withColumn("embedding", embed("instruction"))
        routing.route(asked, table, a.k, "rid", "embedding", "rid", "expert").write.mode("overwrite").json(a.output)


if __name__ == "__main__":
    main()
