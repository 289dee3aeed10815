"""Categories end to end: prompts, answers, parsing, comparison, responses, checks, quota.

Each function takes a responder (``sources.responder``) and returns rows as they are stored: category,
instruction, response, and system or working columns where a category has them.  A round is one plan;
what a sequential loop would do until its target is met is a quota over rows in the order of
``rid`` (batch, then place in the answer).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as S
from ..operators import conversation, filters, parsers, sampling
from ..storage import cut
from . import categories
from .generate import accept, respond

# Texts that stored rows hold.
EDIT = "Rewrite the following text to improve/correct it.\n\nText: "
ROLE = "You are to take on the role of: "
DETAIL = "  Include a brief bit of detail/context in your response, but don't repeat/restate the input."
GOAL = ("\n\nYour response should be approximately ", " words.")


def _numbered(rows: DataFrame, batch: str) -> DataFrame:
    """``rid``: batch, then position; an answer holds fewer than 2**20 rows."""
    at = F.col("pos") if "pos" in rows.columns else F.lit(0)
    return rows.withColumn("rid", F.shiftleft(F.col(batch).cast("bigint"), 20) + at)


def run(name: str, prompts: DataFrame, responder, batch: str = "batch", history: DataFrame | None = None, embed: Callable[[Column], Column] | None = None, template: str | None = None, target: int | None = None, existing: DataFrame | None = None, detailed: float = 0.0, **values) -> DataFrame:
    """Rows of the categories made from one kind of prompt: (rid, category, instruction, response, ...).

    prompts: (batch, prompt).  history: (rid, embedding) of stored rows.  Without ``embed`` nothing is
    compared.  template: of the prompt for a response, where answers hold instructions only.
    detailed: the share of finished rows that are answered once more, with some detail.
    """
    c = categories.CATEGORIES[name]
    answers = responder.respond(prompts, F.col("prompt"), out="text", filtered=c.filtered).where(~S.is_blank("text")).select(batch, "text")
    rows = _numbered(categories.GRAMMARS[c.grammar](answers, "text"), batch)
    if embed is not None:
        if history is None:
            history = rows.sparkSession.createDataFrame([], "rid bigint, embedding array<double>")
        rows = accept(rows, history.select("rid", F.col("embedding").alias("__v")), embed, c.threshold or 0.35, "rid", not c.batchwise)
    if c.mark is not None:
        rows = c.mark(rows)
    if "response" not in rows.columns:
        rows = respond(rows, responder, template, c.filtered, c.ask() if c.ask else None, **values)
    if c.keep is not None:
        rows = rows.withColumn("response", c.keep())
    rows = categories.finish(rows.where(~S.is_blank("response")), name)
    if detailed:
        # they come after the rows of their batch
        more = details(rows, responder, DETAIL, detailed).withColumn("rid", F.col("rid") + (1 << 19))
        rows = rows.unionByName(more, allowMissingColumns=True)
    if target is not None:
        rows = sampling.quota(rows, "category", "rid", F.lit(target), existing)
    return rows


def topics(prompts: DataFrame, responder, batch: str = "batch") -> DataFrame:
    """(topic_idx, topic): the topics that answers list, the first of each, numbered from 0 in the
    order of their answers. prompts: (batch, prompt)."""
    answers = responder.respond(prompts, F.col("prompt"), out="text").where(~S.is_blank("text")).select(batch, "text")
    found = _numbered(parsers.topics(answers, "text", batch), batch).withColumn("__one", F.lit(0))
    numbered, at, _ = sampling.numbered_in_ranges(found, "__one", "rid")
    return numbered.select(at.alias("topic_idx"), "topic")


@dataclass(frozen=True)
class Wishes:
    """What prompts for contextual rows may ask for; each text is one line of the prompt."""

    targets: tuple[str, ...] = ("All tasks should be about one of the texts.", "Tasks should need several of the texts.")
    displays: tuple[str, ...] = ("a numbered list", "bullet points", "a paragraph")
    styles: tuple[str, ...] = ()
    formats: tuple[str, ...] = ()
    display: str = "Show the tasks as {display}."
    format_task: str = "Ask in one task for a certain output format, such as {formats}."
    separate: str = "No text should refer to another."
    related: str = "One text should refer to details of another."
    linked: str = "One text should refer to details of another through its metadata, for example by a link."
    source: str = "Ask for sources where the texts name any."
    source_as: str = " They should be given as {format}."
    unrelated: str = "One task should have nothing to do with the texts."
    unanswerable: str = "One task should be near the texts' subject, but none of them should answer it."


def contextual_prompts(template: str, batches: DataFrame, topics: DataFrame, n_topics: int, wishes: Wishes = Wishes(), seed: int = 0, **values) -> DataFrame:
    """(batch, prompt) for texts with tasks about them; the number of texts, of tasks and of metadata
    pairs, and what else is asked for, are drawn by hashes of the batch.

    Batches take the next topics in rotation, one a text; topics: (topic_idx, topic).  Template:
    input_count, metadata_counts, target_selection, task_count, styles, format_task, topics,
    include_source, task_display_style, reference_texts, task_confounder, next_year, and ``values``.
    """
    w, b = wishes, "batch"
    chance = lambda p, salt: sampling.bernoulli(p, seed + salt, b)
    pick = lambda options, salt, *key: sampling.weighted(list(options), [1] * len(options), seed + salt, b, *key) if options else F.lit("")
    texts = F.sequence(F.lit(1), F.col("n_texts"))
    lines = lambda line: F.array_join(F.transform(texts, lambda i: F.concat(*line(i))), "\n")
    number = lambda i: i.cast("string")

    rows = batches.select(b).withColumn("n_texts", sampling.weighted([1, 2, 3, 4], [3, 2, 1, 1], seed, b)).withColumn("n_tasks", sampling.weighted([1, 2, 3], [3, 2, 1], seed + 1, b))
    slots = sampling.running_total(rows, "n_texts", b).select("*", F.explode(F.sequence(F.lit(0), F.col("n_texts") - 1)).alias("i"))
    slots = slots.withColumn("slot", F.col("running") - F.col("n_texts") + F.col("i"))
    held = sampling.rotated(slots, "slot", topics, "topic_idx", n_topics).groupBy(b, "n_texts", "n_tasks").agg(F.sort_array(F.collect_list(F.struct("i", S.quoted("topic").alias("t")))).alias("x"))

    metadata = lines(lambda i: [F.lit("- context block "), number(i), F.lit(" should have "), F.floor(sampling.draw(seed + 2, b, i) * 9).cast("string"), F.lit(" metadata pairs")])
    styles = lines(lambda i: [F.lit("- text "), number(i), F.lit(" should be in the form of: "), pick(w.styles, 3, i)]) if w.styles else F.lit("")
    formats = F.array(*map(F.lit, w.formats)) if w.formats else F.array().cast("array<string>")
    some = F.slice(F.array_sort(F.transform(formats, lambda f: F.struct(F.xxhash64(F.lit(seed + 4), F.col(b), f).alias("h"), f.alias("f")))), 1, 3)
    format_task = F.when(chance(0.2 if w.formats else 0.0, 5), S.fill(w.format_task, formats=F.array_join(F.transform(some, lambda x: x["f"]), ", "))).otherwise("")
    together = F.when(chance(0.1, 6) & (F.col("n_texts") > 1), F.when(chance(0.5, 7), w.linked).otherwise(w.related)).otherwise(w.separate)
    source_as = F.when(chance(0.2 if w.formats else 0.0, 8), S.fill(w.source_as, format=pick(w.formats, 9))).otherwise("")
    source = F.when(chance(0.2, 10), F.concat(F.lit(w.source), source_as)).otherwise("")
    confounder = F.when(chance(0.1, 11), F.when(chance(0.5, 12), w.unrelated).otherwise(w.unanswerable)).otherwise("")
    about = S.numbered(F.transform("x", lambda x: x["t"]), " * text ", " should be related to topic: ")
    bound = dict(input_count=F.col("n_texts"), metadata_counts=metadata, target_selection=pick(w.targets, 13), task_count=F.col("n_tasks"), styles=styles, format_task=format_task, topics=about, include_source=source, task_display_style=S.fill(w.display, display=pick(w.displays, 14)), reference_texts=together, task_confounder=confounder, next_year=S.next_year())
    return held.select(b, S.fill(template, **{**bound, **values}).alias("prompt"))


def details(rows: DataFrame, responder, wish: str, share: float = 0.5, seed: int = 0) -> DataFrame:
    """Variants of a share of trivia rows that ask for more, answered without the terse system prompt."""
    asked = rows.where(sampling.bernoulli(share, seed, "rid")).withColumn("instruction", F.concat("instruction", F.lit(wish))).drop("response", "system")
    return respond(asked, responder)


def counterfactual(prompts: DataFrame, responder, template: str, batch: str = "batch", ask_source: Column | None = None, **values) -> DataFrame:
    """Two rows for each numbered fact: the true version (variant 0) and the counter one (1)."""
    answers = responder.respond(prompts, F.col("prompt"), out="text").where(~S.is_blank("text")).select(batch, "text")
    rows = parsers.counterfactuals(parsers.sections(answers, "text"), F.lit("") if ask_source is None else ask_source)
    return categories.finish(respond(rows, responder, template, **values), "counterfactual_contextual")


def characters(prompts: DataFrame, responder, **options) -> DataFrame:
    """(rid, name, description, stay_in_character): the cards of answers that name their character."""
    rows = run("character", prompts, responder, **options)
    name, described = parsers.named("instruction")
    return rows.select("rid", name.alias("name"), described.alias("description"), F.col("response").alias("stay_in_character")).where("name <> '' and description <> ''")


def awareness(batches: DataFrame, cards: DataFrame, responder, templates: dict[str, str], names: list[str], batch: str = "batch", history: DataFrame | None = None, embed: Callable[[Column], Column] | None = None, seed: int = 0, **values) -> DataFrame:
    """Two rows for each question: the plain answer (variant 0) and the one that is aware of a place, a
    time or a character (1).

    batches: (batch); which of the three kinds a batch asks for is drawn, and for a character the sense
    too. Characters take turns: the n-th batch about one gets the n-th card that is no AI's, modulo their
    number. cards: (card_idx, name, description).  templates: location, temporal, character, with
    the places name, character and question_type.  names: the other one in chats.
    """
    drawn = batches.select(batch).withColumn("kind", categories.question_kinds(seed, batch)).withColumn("question_type", categories.character_senses(seed + 1, batch))
    human = cut(cards.where(~filters.is_ai_character("description")).select("card_idx", "name", "description"))
    human, at, n = sampling.numbered_in_ranges(human.withColumn("__one", F.lit(0)), "__one", "card_idx")
    human = cut(human.select(at.alias("__card"), n.alias("__cards"), "name", "description"))
    about, nth, _ = sampling.numbered_in_ranges(drawn.where("kind = 'character'"), "kind", batch)
    about = about.select(batch, "kind", "question_type", nth.alias("__n"))
    count = human.select("__cards").limit(1)
    about = about.join(F.broadcast(count)).withColumn("__card", F.pmod("__n", "__cards")).join(human.drop("__cards"), "__card").select(batch, "kind", "question_type", "name", "description")
    none = F.lit(None).cast("string")
    asked = about.unionByName(drawn.where("kind <> 'character'").select(batch, "kind", none.alias("question_type"), none.alias("name"), none.alias("description")))
    prompt = F.lit(None).cast("string")
    for kind, template in templates.items():
        bound = {"name": F.coalesce("name", F.lit("")), "character": F.coalesce("description", F.lit("")), "question_type": F.coalesce("question_type", F.lit("")), **values}
        prompt = F.when(F.col("kind") == kind, S.fill(template, **bound)).otherwise(prompt)
    answers = cut(responder.respond(asked, prompt, out="text", filtered=False).where(~S.is_blank("text")))
    other = sampling.weighted(names, [1] * len(names), seed + 2, batch)
    plain = parsers.awareness(answers.where("kind <> 'character'").select(batch, "kind", "text"), "text")
    personal = parsers.character_awareness(answers.where("kind = 'character'").select(batch, "kind", "name", "description", "text"), "text", "name", "description", other).drop("name")
    rows = _numbered(plain.unionByName(personal.drop("__other"), allowMissingColumns=True), batch)
    if embed is not None:
        c = categories.CATEGORIES["awareness"]
        if history is None:
            history = rows.sparkSession.createDataFrame([], "rid bigint, embedding array<double>")
        rows = cut(rows)
        fresh = accept(rows.where("variant = 0"), history.select("rid", F.col("embedding").alias("__v")), embed, c.threshold or 0.35, "rid", True)
        rows = rows.join(fresh.select("rid"), "rid", "left_semi")
    return rows


def judged(rows: DataFrame, responder, template: str, threshold: str = "100", about_system: str = "{system}") -> DataFrame:
    """Rows that the judge does not call bad. The template gets instruction, response, threshold and
    system_prompt (``about_system`` where a row has a system prompt, else nothing). No verdict keeps."""
    system = F.col("system") if "system" in rows.columns else F.lit(None).cast("string")
    about = F.when(system.isNull() | (system == ""), F.lit("")).otherwise(S.fill(about_system, system=system))
    prompt = S.fill(template, instruction=F.col("instruction"), response=F.col("response"), threshold=threshold, system_prompt=about)
    return responder.respond(rows, prompt, out="__verdict").where(filters.judged_good("__verdict")).drop("__verdict")


def detailed_writing(prompts: DataFrame, responder, first: str, inner: str, final: str, combine: str, word_count: int = 4000, batch: str = "batch") -> DataFrame:
    """A chain of answers: an instruction, three parts of a response, and the parts rewritten as one,
    whose length in words the instruction then names. A row that lacks an answer is gone.

    Templates: first (instruction, word_count, third), inner and final (third, sofar), combine
    (instruction, response).
    """
    words = int(word_count * 1.3)
    third = words // 3
    rows = responder.respond(prompts, F.col("prompt"), out="instruction").where(~S.is_blank("instruction"))
    sofar = F.lit("")
    for i, template in enumerate((first, inner, final)):
        ask = S.fill(template, instruction=F.col("instruction"), word_count=words, third=third, sofar=sofar)
        rows = responder.respond(rows, ask, out=f"__part{i}", filtered=i > 0).where(~S.is_blank(f"__part{i}"))
        part = F.col(f"__part{i}") if i == 2 else S.strip(f"__part{i}")
        sofar = part if i == 0 else F.concat(sofar, F.lit("\n\n"), part)
    rows = responder.respond(rows, S.fill(combine, instruction=F.col("instruction"), response=sofar), out="response").where(~S.is_blank("response"))
    goal = F.concat(S.strip("instruction"), F.lit(GOAL[0]), S.space_count("response").cast("string"), F.lit(GOAL[1]))
    return rows.select(batch, F.lit("detailed_writing").alias("category"), goal.alias("instruction"), S.strip("response").alias("response"))


def stylised(sources: DataFrame, cards: DataFrame, n_cards: int, responder, rules: str, key: str, seed: int = 0) -> DataFrame:
    """Instructions answered again by characters, the n-th by card n modulo their number. cards:
    (card_idx, name, description, stay_in_character); the base of the system prompt is stored."""
    pairs = categories.stylised_pairs(sources.select(key, "instruction"), cards, n_cards, key, seed)
    system = F.concat_ws("\n", F.concat(F.lit(ROLE), "name"), "description", "stay_in_character")
    asked = pairs.withColumn("system", system)
    prompt = F.concat_ws("\n", "system", F.lit(rules), "instruction")
    made = responder.respond(asked, prompt, out="__answer", filtered=False).withColumn("response", filters.stylised("__answer")).where(~S.is_blank("response"))
    return made.select(key, F.lit("stylized_response").alias("category"), "system", "instruction", "response")


def get_to_know(cards: DataFrame, responder, template: str, rules: str, user: Column, most_words: int = 2500, card: str = "card_idx", **values) -> DataFrame:
    """A chat with each character, a row for each answer after the first and before the last that the
    budget of words has room for: the instruction is the description and all that was said."""
    asked = responder.respond(cards.withColumn("__user", user), S.fill(template, name=F.col("name"), description=F.col("description"), **values), out="__text", filtered=False).where(~S.is_blank("__text"))
    base = F.concat(F.lit("A chat between "), "name", F.lit(" and "), "__user", F.lit(".\nDescription of "), "name", F.lit(":\n"), "description", F.lit("\n\n\n"), "stay_in_character")
    rows = parsers.rows_of(asked.select(card, "name", "__user", base.alias("__base"), "__text"), "__text", parsers.QUESTIONS, ["question"])
    answered = responder.respond(rows, F.concat_ws("\n", "__base", F.lit(rules), "question"), out="__answer", filtered=False)
    said = answered.withColumn("assistant", S.strip(S.first_part("__answer", "REMINDER:"))).where(~S.is_blank("assistant"))
    turns = Window.partitionBy(card).orderBy("pos")
    said = said.withColumn("idx", F.row_number().over(turns) - 1).withColumn("user", F.col("question"))
    line = F.concat("__user", F.lit(": "), S.strip("user"), F.lit("\n"), "name", F.lit(": "), S.strip("assistant"))
    before = F.array_join(F.collect_list(line).over(turns.rowsBetween(Window.unboundedPreceding, -1)), "\n")
    kept = conversation.budgeted_rows(said.withColumn("__before", before), S.word_count("__base"), most_words, card)
    instruction = F.concat(S.strip("__base"), F.lit("\n\n"), "__before", F.lit("\n"), "__user", F.lit(": "), S.strip("user"))
    return kept.select(card, "idx", F.lit("gtkm").alias("category"), instruction.alias("instruction"), F.concat("name", F.lit(": "), S.strip("assistant")).alias("response"), (F.col("idx") > 1).alias("skip_counting"), F.lit(True).alias("skip_prompt_formatting"))


def editor(writing: DataFrame, responder, template: str, key: str = "rid", **values) -> DataFrame:
    """From a degraded version, made by the responder, back to the original response."""
    asked = responder.respond(writing, S.fill(template, text=F.col("response"), **values), out="__worse").where(~S.is_blank("__worse"))
    return asked.select(key, F.lit("editor").alias("category"), F.concat(F.lit(EDIT), S.strip("__worse")).alias("instruction"), S.strip("response").alias("response"))
