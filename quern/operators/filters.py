"""Predicates on responses, requests and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as S

# Patterns of refusals and leaks (case does not matter), and openings of apologies.
BANNED = (
    "my programming",
    "openai",
    "language model",
    "large language",
    "as an? (ai|generative language|gpt|bot)",
    "illegal and dangerous",
    "i do(n't| not) (possess|have|exhibit) (personal|consciousness|subjective)",
    "personal (feelings|thoughts|emotions|desires|experiences|goals|objective|belief)",
    r"(can('t| ?not)|w(on't|will not)|unable.?) (\w+\s)+(with (that|your)|your \w+|provide)",
    "my limitations",
    "the limitations of my",
    "my abilities",
    "violates my",
    "i (can('t| ?not)|w(on't|will not)|am (not |un)able.?).{0,30}(you are|you're|your )",
    "please note that",
    "flesch",
)
APOLOGIES = ("I'm sorry,", "Apologies,", "I can't", "I won't")
# What trivia questions say about their answer, AI characters, and texts with their tasks.
EDGES = r"""(start|end)(?:s|ing) with ['"]([^'"]+)['"]"""
CONTAINS = r"""(?:with|contain(?:s|ing)|hav(?:e|ing)) ['"]([^'"]+)['"]"""
AI_CHARACTER = r"(?i) (AI|artificial intelligence)[,\.\s]"
CONTEXT_BLOCKS = r"(?sU)\A\s*(?:BEGININPUT\s+BEGINCONTEXT.*?ENDCONTEXT.*?ENDINPUT\s*)+BEGININSTRUCTION.*ENDINSTRUCTION\s*\z"
# Categories that are neither compared nor judged when culling.
PASS_THROUGH = ("stylized_response", "rp", "detailed_writing", "contextual", "counterfactual_contextual", "plan", "song", "wordgame")


def is_banned(text, patterns=BANNED, from_third: bool = False) -> Column:
    """Any pattern occurs. ``from_third`` looks from the third character on, as the behaviour to
    match does; patterns that look behind or anchor at the start need the whole text."""
    t = F.substr(S._c(text), F.lit(3)) if from_third else S._c(text)
    return t.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in patterns))


def is_apology(text) -> Column:
    out = F.lit(False)
    for a in APOLOGIES:
        out = out | F.startswith(S._c(text), F.lit(a))
    return out


def is_cut(finish_reason) -> Column:
    """Stopped by the length limit, or nothing was returned."""
    return F.coalesce(S._c(finish_reason) == "length", F.lit(True))


def usable(text, patterns=BANNED, from_third: bool = False) -> Column:
    """Neither null, blank, banned nor an apology."""
    return F.coalesce(~S.is_blank(text) & ~is_banned(text, patterns, from_third) & ~is_apology(text), F.lit(False))


def is_context_block(text) -> Column:
    return S._c(text).rlike(CONTEXT_BLOCKS)


def answer_in_question(instruction, response) -> Column:
    """Multiple choice: the stripped answer is one of the options shown."""
    return F.contains(S._c(instruction), S.strip(response))


def trivia_edges_hold(instruction, response) -> Column:
    """``starts with 'x'`` / ``ends with 'x'`` is true of the response, case aside. Null for a null instruction.

    As many code points as the value has are compared, so case mappings that change lengths or hang on
    what follows do not matter; a value in capitals is also met by what has these capitals (``ς`` and ``Σ``)."""
    i, r = S._c(instruction), S._c(response)
    side, value = F.regexp_extract(i, EDGES, 1), F.regexp_extract(i, EDGES, 2)

    def same(edge: Column) -> Column:
        capitals = S.upper_each(value)
        return (S.lower_each(edge) == S.lower_each(value)) | ((capitals == value) & (S.upper_each(edge) == capitals))

    holds = F.when(side == "start", same(F.left(r, F.length(value)))).when(side == "end", same(F.right(r, F.length(value))))
    return F.when(i.isNotNull(), holds.otherwise(True))


def trivia_contains_holds(instruction, response) -> Column:
    i = S._c(instruction)
    value = F.regexp_extract(i, CONTAINS, 1)
    return (value == "") | F.contains(S._c(response), value)


def is_ai_character(description) -> Column:
    return S._c(description).rlike(AI_CHARACTER)


def stylised(response) -> Column:
    """The response up to a reminder; null where it asks to be skipped."""
    r = S._c(response)
    return F.when(F.contains(r, F.lit("SKIP")), None).otherwise(S.strip(S.first_part(r, "REMINDER:")))


def judged_good(result) -> Column:
    """No verdict counts as good."""
    return F.coalesce(F.contains(S._c(result), F.lit("GOOD")), F.lit(True))


def in_range(*values) -> Column:
    """No sampling parameter is negative; null ones are not checked."""
    return F.least(F.lit(0.0), *[F.coalesce(S._c(v).cast("double"), F.lit(0.0)) for v in values]) >= 0


def new_tokens(prompt_tokens, max_tokens, max_len: int) -> Column:
    """The room asked for, or what is left."""
    return F.coalesce(F.nullif(S._c(max_tokens), F.lit(0)), F.lit(max_len) - S._c(prompt_tokens) - 1)


def fits(prompt_tokens, max_tokens, max_len: int) -> Column:
    return S._c(prompt_tokens) + new_tokens(prompt_tokens, max_tokens, max_len) <= max_len


def registered(df: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    return df.join(known.select(F.col(name).alias("__known")).distinct(), F.col(column) == F.col("__known"), "left_semi")


def default_threshold(value, default: float = 0.35) -> Column:
    """Zero and null stand for the default."""
    return F.coalesce(F.nullif(S._c(value).cast("double"), F.lit(0.0)), F.lit(default))


def split_pass_through(df: DataFrame, category: str = "category", listed=PASS_THROUGH) -> tuple[DataFrame, DataFrame]:
    """(rows that pass unjudged, the others); null categories are among the others."""
    passing = F.coalesce(F.col(category).isin(*listed), F.lit(False))
    return df.where(passing), df.where(~passing)
