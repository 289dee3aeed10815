"""The registry of category dataflows: grammar, comparison, answer policy and example limits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as S
from ..operators import filters, parsers, sampling

GRAMMARS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "tasks": parsers.tasks,
    "tasks_strict": lambda df, t: parsers.tasks(df, t, strict=True),
    "question": parsers.inline_qa,
    "prompt": lambda df, t: parsers.inline_qa(df, t, "PROMPT"),
    "description": lambda df, t: parsers.inline_qa(df, t, "DESCRIPTION", "GUIDE"),
    "awareness": parsers.awareness,
    "questions": parsers.questions,
    "experience": lambda df, t: parsers.experience(df, t).toDF(*[c for c in df.columns if c != t], "instruction", "response").where(~S.is_blank("instruction")),
    "sections": parsers.sections,
    "context": lambda df, t: df.where(filters.is_context_block(t)).withColumnRenamed(t, "instruction"),
    "whole": lambda df, t: df.where(~S.is_blank(t)).withColumnRenamed(t, "instruction"),
}


@dataclass(frozen=True)
class Category:
    """How rows of a category are made. ``batchwise``: rows are compared with history only, not with
    each other; ``filtered``: refusals are filtered; ``check``: a condition on finished rows.

    ``mark``: rows with a mark on some instructions, made after the comparison; ``ask``: the text asked
    for a response, where it is not the instruction; ``keep``: what is stored of a response, null drops
    the row.
    """

    grammar: str
    batchwise: bool
    count: int
    batch: int | None
    threshold: float | None
    filtered: bool = True
    check: Callable | None = None
    system: str | None = None
    after: tuple[str, ...] = ()
    mark: Callable[[DataFrame], DataFrame] | None = None
    ask: Callable[[], Column] | None = None
    keep: Callable[[], Column] | None = None


PLAIN = "PLAINFORMAT"  # fixed value: the mark of instructions that want code only
CODE_ONLY = "Answer with the code alone, commented, without an introduction, notes on its use, or fences."


def marked_plain(rows: DataFrame, share: float = 0.5, seed: int = 0) -> DataFrame:
    """A share of the instructions, by a hash of ``rid``, ask for plain code and say so by a mark."""
    chosen = sampling.bernoulli(share, seed, "rid")
    return rows.withColumn("instruction", F.when(chosen, F.concat(S.strip("instruction"), F.lit(f" {PLAIN}"))).otherwise(F.col("instruction")))


def _plain_asked() -> Column:
    """A marked instruction asks in words instead of the mark."""
    words = F.concat(S.strip(F.regexp_replace("instruction", f"{PLAIN}$", "")), F.lit("\n" + CODE_ONLY))
    return F.when(F.endswith("instruction", F.lit(PLAIN)), words).otherwise(F.col("instruction"))


def _trivia():
    return filters.trivia_edges_hold("instruction", "response") & filters.trivia_contains_holds("instruction", "response")


# Example limits of each category.
CATEGORIES: dict[str, Category] = {
    "general": Category("tasks_strict", True, 100, 10, None),
    "contextual": Category("context", True, 70, None, None),
    "counterfactual_contextual": Category("sections", True, 30, 10, None),
    "coding": Category("tasks_strict", True, 100, 10, 0.02, filtered=False, mark=marked_plain, ask=_plain_asked, keep=lambda: parsers.plain_code("instruction", "response")),
    "trivia": Category("question", False, 100, 20, 0.035, check=_trivia, system="You are a world class trivia AI - provide accurate, succinct responses."),
    "experience": Category("experience", False, 100, 3, 0.1, filtered=False),
    "orca": Category("question", False, 100, 10, 0.02),
    "riddle": Category("question", False, 100, 50, 0.01),
    "wordgame": Category("tasks", True, 100, 10, 0.01),
    "roleplay": Category("tasks", True, 100, 10, 0.1),
    "cot": Category("tasks", True, 50, 5, 0.03, filtered=False),
    "agent": Category("prompt", False, 100, 5, 0.03, filtered=False),
    "plan": Category("tasks", True, 100, 1, 0.02, filtered=False),
    "writing": Category("tasks", True, 100, 12, 0.1),
    "card": Category("prompt", False, 50, 5, 0.05),
    "joke": Category("question", False, 100, 20, 0.06),
    "song": Category("tasks", True, 200, 25, 0.1),
    "multiple_choice": Category("question", False, 100, 5, 0.03, check=lambda: filters.answer_in_question("instruction", "response")),
    "detailed_writing": Category("whole", True, 50, 2, 0.1),
    "character": Category("description", False, 25, 1, 0.1, filtered=False),
    "rp": Category("whole", True, 25, None, None, after=("character",)),
    "stylized_response": Category("whole", True, 100, 15, 0.3, after=("character", "general", "writing")),
    "gtkm": Category("questions", True, 100, None, None, filtered=False, after=("character",)),
    "misconception": Category("question", False, 500, 25, 0.02),
    "awareness": Category("awareness", False, 100, 5, 0.1, filtered=False, after=("character",)),
    "editor": Category("whole", True, 100, 5, None, after=("writing",)),
}


def register(name: str, category: Category, grammar: Callable[[DataFrame, str], DataFrame] | None = None) -> None:
    """Adds a category, and its grammar where that is new; a known name gets the new settings."""
    if grammar is not None:
        GRAMMARS[category.grammar] = grammar
    if category.grammar not in GRAMMARS:
        raise ValueError(f"{name}: no grammar {category.grammar}")
    CATEGORIES[name] = category


def order_of_phases(names) -> list[list[str]]:
    """Categories in phases: one that reads others' output comes after them; unknown names are left out."""
    left, done, phases = [n for n in names if n in CATEGORIES], set(), []
    while left:
        now = [n for n in left if not (set(CATEGORIES[n].after) & set(left))]
        phases.append(now)
        done |= set(now)
        left = [n for n in left if n not in done]
    return phases


def finish(rows: DataFrame, name: str) -> DataFrame:
    """Finished rows of a category: its check applied, its name and system prompt set."""
    c = CATEGORIES[name]
    out = rows.where(c.check()) if c.check else rows
    out = out.withColumn("category", F.lit(name))
    return out.withColumn("system", F.lit(c.system)) if c.system else out


def writing_styles(styles: list[str], batch: int) -> list[str]:
    """Directives for a quarter of a batch, one at least where it has several rows, no more than there are styles."""
    n = min(batch // 4 or int(batch > 1), len(styles))
    return [f"- TSK {i + 1}: in the style of {s}" for i, s in enumerate(styles[:n])]


def stylised_pairs(sources: DataFrame, cards: DataFrame, n_cards: int, source_key: str, seed: int = 0) -> DataFrame:
    """The n-th instruction in the order of a draw with card n modulo the number of cards. cards: (card_idx, ...)."""
    drawn = sources.withColumn("__one", F.lit(0)).withColumn("__o", F.struct(sampling.draw(seed, source_key).alias("u"), F.col(source_key).alias("k")))
    numbered, at, _ = sampling.numbered_in_ranges(drawn, "__one", "__o")
    numbered = numbered.withColumn("__n", at).select(*[F.col(f"`{c}`") for c in sources.columns], "__n")
    return numbered.join(cards.where(F.col("card_idx") < n_cards), F.pmod("__n", F.lit(n_cards)) == F.col("card_idx")).drop("__n")


def question_kinds(seed: int, *keys):
    """Kinds of awareness prompts: location, temporal, character."""
    return sampling.weighted(["location", "temporal", "character"], [0.2, 0.2, 0.6], seed, *keys)


def character_senses(seed: int, *keys):
    """What a prompt about a character's awareness asks about."""
    return sampling.weighted(["corporeal awareness", "location", "physical senses"], [1, 1, 1], seed, *keys)
