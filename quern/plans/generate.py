"""One round of generation: prompts, answers, parsing, comparison with history, quota."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as S
from ..operators import parsers, sampling
from ..operators.similarity import drop_similar, greedy_dedup, too_similar


def topic_prompts(template: str, topics: DataFrame, n_topics: int, batches: DataFrame, batch_size: int, start: int = 0, label: str = "TSK", **values) -> DataFrame:
    """(batch, prompt): each batch gets the next ``batch_size`` topics in rotation. topics: (topic_idx, topic)."""
    slots = batches.select("batch", F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1))).alias("i")).withColumn("slot", F.col("batch") * batch_size + F.col("i"))
    held = sampling.rotated(slots, "slot", topics, "topic_idx", n_topics, start).groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("i", S.quoted("topic").alias("t")))).alias("x"))
    lines = S.numbered(F.transform("x", lambda x: x["t"]), f" * {label} ", " must be related to topic: ")
    return held.select("batch", S.fill(template, topics=lines, batch_size=batch_size, **values).alias("prompt"))


def parsed(answers: DataFrame, grammar: str, text: str = "text") -> DataFrame:
    """Rows of answers under a grammar of ``categories.GRAMMARS``."""
    from .categories import GRAMMARS

    return GRAMMARS[grammar](answers, text)


def accept(rows: DataFrame, history: DataFrame, embed: Callable, threshold: float, key: str, sequential: bool) -> DataFrame:
    """Rows that are not too similar to ``history`` (key, embedding) and, where rows are accepted one by
    one, not to an earlier accepted row either."""
    embedded = rows.withColumn("__v", embed(F.col("instruction")))
    fresh = drop_similar(embedded, history, threshold, key, "__v", key) if not history.isEmpty() else embedded
    return (greedy_dedup(fresh, threshold or 0.35, key, "__v") if sequential else fresh).drop("__v")


def flags(rows: DataFrame, history: DataFrame, embed: Callable, threshold: float, key: str) -> DataFrame:
    return too_similar(rows.withColumn("__v", embed(F.col("instruction"))), history, threshold, key, "__v", key)


def respond(rows: DataFrame, responder, template: str | None = None, filtered: bool = True, ask=None, **values) -> DataFrame:
    """Rows with a usable ``response``; the prompt is the instruction (or ``ask``), or a template around it."""
    ask = F.col("instruction") if ask is None else ask
    prompt = ask if template is None else S.fill(template, instruction=ask, **values)
    out = responder.respond(rows, prompt, filtered=filtered)
    return out.where(~S.is_blank("response")).withColumn("instruction", S.strip("instruction")).withColumn("response", S.strip("response"))
