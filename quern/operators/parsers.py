"""Marked-up text to rows.  Offsets of matches are kept as ordinals, never as file order."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as S

# The grammars' patterns, and the words around a text with its task. (?d) makes $ know line feeds only.
TOPICS = r"(?sd)(?:^|\n)\d+\. (.*?)(?:$|(?=\n\d+\. ))"
TASKS = r"(?sdU)(?:^|\n)TSK \d+\.\s*(.*?)(?:$|(?=\nTSK \d+\.\s*))"
TASKS_STRICT = r"(?sdU)(?:^|\n)TSK \d+\. (.*?)(?:$|(?=\nTSK \d+\. ))"
AWARENESS = r"(?sd)QUESTION:(.*?)CONTEXT:(.*?)ANSWER:(.*?)CONTEXTUALANSWER:(.*?)(?=QUESTION|$)"
AWARENESS_CHARACTER = r"(?sd)QUESTION:(.*?)ANSWER:(.*?)CONTEXTUALANSWER:(.*?)(?=QUESTION|$)"
QUESTIONS = r"(?sd)QUESTION:(.*?)(?=QUESTION|$)"
SECTIONS = r"(?s)FACTS(.*)COUNTER(.*)QUESTIONS(.*)"
NUMBERED = r"(?sd)(?:^|\n)(\d+)\. (.*?)(?:$|(?=\n\d+\. ))"
URL = r"(\[(?:\w+:\s*)?(https.*?)\])"
FENCE = r"```[^\n]*(?:$|[\r\n])"
EXPERIENCE = r"(?sU)SETTING:\s*(.*?)EXPERIENCE:\s*(.*)"
NAME = r"(?U)(NAME:\s*([^\n]+)\s*)"
NEXT = r"(?U)(NEXT:\s*([^\n]+))"
FUNCTION = r'(?iU)"function":\s*"([^"]+)"'
CONTEXT = ("BEGININPUT\nBEGINCONTEXT\nurl: ", "\nENDCONTEXT\n", "\nENDINPUT\nBEGININSTRUCTION\n", "\n", "\nENDINSTRUCTION")
TURN = r"(?sU)\A\s*USER:(.*?)ASSISTANT:(.*)\s*\z"


def all_matches(text, pattern: str, names: list[str]) -> Column:
    """An array of structs, one for each match, a field for each group."""
    groups = [F.regexp_extract_all(S._c(text), F.lit(pattern), F.lit(i + 1)) for i in range(len(names))]
    return F.transform(groups[0], lambda x, i: F.struct(x.alias(names[0]), *[F.get(g, i).alias(n) for g, n in zip(groups[1:], names[1:], strict=True)]))


def rows_of(df: DataFrame, text: str, pattern: str, names: list[str], ordinal: str = "pos") -> DataFrame:
    """A row for each match, with the other columns of ``df`` and the match's ordinal."""
    keep = [c for c in df.columns if c != text]
    found = df.select(*keep, F.posexplode(all_matches(text, pattern, names)).alias(ordinal, "__m"))
    return found.select(*keep, ordinal, *[F.col("__m")[n].alias(n) for n in names])


def topics(df: DataFrame, text: str, order: str) -> DataFrame:
    """Listed topics: no empty ones, none that end in a colon, the first of each without case and
    surrounding space. Columns: ``order``, pos, topic."""
    found = rows_of(df.select(order, text), text, TOPICS, ["topic"])
    found = found.where((F.col("topic") != "") & ~F.endswith(S.strip("topic"), F.lit(":")))
    first = found.groupBy(F.lower(S.strip("topic"))).agg(F.min(F.struct(order, "pos", S.strip("topic").alias("topic"))).alias("__f"))
    return first.select("__f.*")


def tasks(df: DataFrame, text: str, strict: bool = False) -> DataFrame:
    """Numbered tasks; blank ones are left out, the text is not stripped."""
    return rows_of(df, text, TASKS_STRICT if strict else TASKS, ["instruction"]).where(~S.is_blank("instruction"))


def inline_qa(df: DataFrame, text: str, start: str = "QUESTION", end: str = "ANSWER") -> DataFrame:
    """Pairs of ``start:``/``end:``, both stripped; pairs with a blank instruction are left out."""
    found = rows_of(df, text, rf"(?sd){start}:(.*?){end}:(.*?)(?={start}|$)", ["instruction", "response"])
    return found.where(~S.is_blank("instruction")).withColumn("instruction", S.strip("instruction")).withColumn("response", S.strip("response"))


def awareness(df: DataFrame, text: str) -> DataFrame:
    """Two rows for each match: the plain answer, and the contextual one under a system prompt."""
    keep = [c for c in df.columns if c != text]
    found = rows_of(df, text, AWARENESS, ["question", "context", "answer", "contextual"]).where(~S.is_blank("question"))
    two = F.array(
        F.struct(F.lit(0).alias("variant"), F.lit(None).cast("string").alias("system"), S.strip("question").alias("instruction"), S.strip("answer").alias("response")),
        F.struct(F.lit(1).alias("variant"), F.concat(F.lit("A chat. "), S.strip("context")).alias("system"), S.strip("question").alias("instruction"), S.strip("contextual").alias("response")),
    )
    return found.select(*keep, "pos", F.explode(two).alias("r")).select(*keep, "pos", "r.*", F.lit("awareness").alias("category"))


def character_awareness(df: DataFrame, text: str, name: str, description: str, other: Column) -> DataFrame:
    """Two rows for each match; the second is a chat of the character and ``other``, whose answer
    loses a leading ``As <name>, ``."""
    keep = [c for c in df.columns if c not in (text, description)]
    found = rows_of(df.withColumn("__other", other), text, AWARENESS_CHARACTER, ["question", "answer", "contextual"]).where(~S.is_blank("question"))
    chat = F.concat(F.lit("A chat between "), F.col(name), F.lit(" and "), "__other", F.lit(".\n"), F.col(name), F.lit(":\n"), F.col(description), F.lit("\n"), "__other", F.lit(": "), S.strip("question"))
    two = F.array(
        F.struct(F.lit(0).alias("variant"), S.strip("question").alias("instruction"), S.strip("answer").alias("response"), F.lit(None).cast("boolean").alias("skip_prompt_formatting")),
        F.struct(F.lit(1).alias("variant"), chat.alias("instruction"), S.without_prefix(S.strip("contextual"), F.concat(F.lit("As "), F.col(name), F.lit(", "))).alias("response"), F.lit(True).alias("skip_prompt_formatting")),
    )
    return found.select(*keep, "pos", F.explode(two).alias("r")).select(*keep, "pos", "r.*", F.lit("awareness").alias("category"))


def questions(df: DataFrame, text: str) -> DataFrame:
    return rows_of(df, text, QUESTIONS, ["question"]).withColumn("question", S.strip("question")).where("question <> ''")


def experience(df: DataFrame, text: str) -> DataFrame:
    """(setting, experience) of texts that hold both."""
    keep = [c for c in df.columns if c != text]
    setting, told = (F.regexp_extract(text, EXPERIENCE, i) for i in (1, 2))
    return df.where(F.col(text).rlike(EXPERIENCE)).select(*keep, S.strip(setting).alias("setting"), S.strip(told).alias("experience"))


def sections(df: DataFrame, text: str) -> DataFrame:
    """Facts, counter-facts and questions joined on their number, with the fact's source, whose
    bracket leaves the fact. Numbers that lack a part are left out; of repeated ones the last counts.
    The join is inside a row's arrays: rows are neither shuffled nor merged."""
    keep = [c for c in df.columns if c != text]
    parts = [all_matches(F.regexp_extract(text, SECTIONS, i), NUMBERED, ["number", "value"]) for i in (1, 2, 3)]
    held = df.where(F.col(text).rlike(SECTIONS)).select(*keep, *[p.alias(n) for p, n in zip(parts, ("__f", "__c", "__q"), strict=True)])
    last = lambda name, n: F.try_element_at(F.filter(name, lambda x: x["number"] == n), F.lit(-1))["value"]
    numbers = F.array_distinct(F.transform("__f", lambda x: x["number"]))
    joined = F.transform(numbers, lambda n: F.struct(n.alias("number"), last("__f", n).alias("fact"), last("__c", n).alias("counter"), last("__q", n).alias("question")))
    rows = held.select(*keep, F.explode(joined).alias("__x")).select(*keep, "__x.*").where("counter is not null and question is not null")
    rows = rows.withColumn("source", F.regexp_extract("fact", URL, 2)).where("source <> ''")
    return rows.withColumn("fact", F.replace("fact", F.regexp_extract("fact", URL, 1), F.lit(""))).select(*keep, "number", "fact", "counter", "question", "source")


def context_prompt(source: Column, fact: Column, question: Column, ask_source: Column) -> Column:
    words = [F.lit(w) for w in CONTEXT]
    return F.concat(words[0], source, words[1], fact, words[2], question, words[3], ask_source, words[4])


def counterfactuals(joined: DataFrame, ask_source: Column) -> DataFrame:
    """Two rows for each number: the true version, then the counter one."""
    keep = [c for c in joined.columns if c not in ("fact", "counter", "question", "source")]
    two = F.array(*[F.struct(F.lit(i).alias("variant"), context_prompt(F.col("source"), F.col(c), F.col("question"), ask_source).alias("instruction")) for i, c in enumerate(("fact", "counter"))])
    return joined.select(*keep, F.explode(two).alias("r")).select(*keep, "r.*")


def named(description) -> tuple[Column, Column]:
    """(name, description without the line that names)."""
    d = S._c(description)
    return S.strip(F.regexp_extract(d, NAME, 2)), S.strip(F.replace(d, F.regexp_extract(d, NAME, 1), F.lit("")))


def plain_code(instruction, response) -> Column:
    """For PLAINFORMAT instructions with a fenced answer: the code in the first fence, null where it
    is empty; other answers stay."""
    r = S._c(response)
    inner = S.strip(F.get(F.split(r, FENCE, -1), F.lit(1)))
    fenced = F.contains(S._c(instruction), F.lit("PLAINFORMAT")) & F.contains(r, F.lit("```"))
    return F.when(fenced, F.nullif(inner, F.lit(""))).otherwise(r)


def conversation(instruction, response) -> Column:
    """The export form: an array of structs (from, value); null where a later part does not match."""
    i, r = S._c(instruction), S._c(response)
    say = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    parts = F.split(r, "</s>", -1)
    first = F.array(say("human", i), say("gpt", F.get(parts, F.lit(0))))
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    turns = F.flatten(F.transform(rest, lambda p: F.array(say("human", S.strip(F.regexp_extract(p, TURN, 1))), say("gpt", S.strip(F.regexp_extract(p, TURN, 2))))))
    return F.when(F.forall(rest, lambda p: p.rlike(TURN)), F.concat(first, turns))


def function_name(response, known: list[str]) -> Column:
    """The function that an agent's answer names, or a known name that it quotes; null if none."""
    r = S._c(response)
    quoted = "|".join("\\Q" + k + "\\E" for k in known)
    named_, listed = F.regexp_extract(r, FUNCTION, 1), F.regexp_extract(r, rf'(?iu)"({quoted})"', 1)
    return F.coalesce(F.nullif(named_, F.lit("")), F.nullif(listed, F.lit("")))


def close_name(name, names, seed: int = 0) -> Column:
    """The closest of an array of names (ratio of matching blocks, 0.6 at least), else the one that
    a hash picks."""

    @F.pandas_udf("string")
    def pick(name: pd.Series, names: pd.Series) -> pd.Series:
        import difflib
        import zlib

        def one(n, all_):
            all_ = list(all_) if all_ is not None else []
            if not all_:
                return None
            found = difflib.get_close_matches(n or "", all_)
            return found[0] if found else all_[zlib.crc32(f"{seed}:{n}".encode()) % len(all_)]

        return pd.Series([one(n, a) for n, a in zip(name, names, strict=True)], dtype=object)

    return pick(S._c(name), S._c(names))


def next_speaker(response, current, user, names: Column, delimiter: str | None = None, seed: int = 0) -> tuple[Column, Column]:
    """(cleaned response, who speaks next) of a role-play answer.

    Reminders and rules are cut; the line that names the next speaker goes; what is said on behalf of
    others goes.  Without such a line the user is next, or, if the user speaks, another one that a
    hash picks.  Unknown names are matched to the closest known one.
    """
    cur, usr = S._c(current), S._c(user)
    r = S.strip(S.first_part(S.strip(S.first_part(response, "REMINDER:")), "RULES:"))
    line, said = F.regexp_extract(r, NEXT, 1), F.replace(S.strip(F.regexp_extract(r, NEXT, 2)), F.lit('"'), F.lit(""))
    others = F.array_sort(F.array_except(names, F.array(usr)))
    other = F.get(others, F.pmod(F.xxhash64(F.lit(seed), r), F.greatest(F.size(others), F.lit(1))).cast("int"))
    body = F.when(line == "", r).otherwise(S.strip(F.replace(r, line, F.lit(""))))
    own = F.concat(cur, F.lit(":"))
    body = S.straight_quotes(F.when(F.startswith(body, own), S.lstrip(F.substr(body, F.length(own) + 1))).otherwise(body))
    foreign = F.array_except(F.array_distinct(F.concat(names, F.array(usr))), F.array(cur))
    ends = F.transform(foreign, lambda n: F.instr(body, F.concat(F.lit("\n"), n, F.lit(":"))))
    cut = F.array_min(F.filter(ends, lambda i: i > 0))
    body = F.coalesce(F.substr(body, F.lit(1), cut - 1), body)
    if delimiter:
        body = S.tidy_actions(body, delimiter)
    wanted = F.when(line != "", said).when(cur == usr, other).otherwise(usr)
    everyone = F.array_distinct(F.concat(names, F.array(usr)))
    known = F.array_contains(everyone, wanted)
    # only unknown names are compared
    return body, F.when(known, wanted).otherwise(close_name(F.when(~known, wanted), F.when(~known, everyone), seed))
