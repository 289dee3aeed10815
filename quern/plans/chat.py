"""Role-play chats between characters, turn by turn: all open chats answer in one plan per turn.

A chat's state is one row, so chats never meet in a task.  Answers of a model may differ when they are
asked for again; each turn is therefore written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as S
from ..operators import conversation, parsers, sampling
from ..storage import cut

# Texts that stored rows hold.
HEAD = ("This is a chat between ", " characters: ")
SETTING = ("Setting for the chat:\n", "\nEnd of setting.")
ACTIONS = ("\nActions should be surrounded by ", ", e.g. ", "slowly turns his gaze towards the lamp")

DELIMITERS = ["*", "~", ""]
#: Failed answers of a chat after which one more ends it.
REROLLS = 3


def _system(delimiter: Column) -> Column:
    names = F.transform("cast", lambda c: c["name"])
    about = F.array_join(F.transform("cast", lambda c: F.concat(c["name"], F.lit(": "), S.strip(c["description"]))), "\n\n")
    head = F.concat(F.lit(HEAD[0]), F.size("cast").cast("string"), F.lit(HEAD[1]), F.array_join(names, ", "))
    base = F.concat_ws("\n\n", head, about, F.concat(F.lit(SETTING[0]), "setting", F.lit(SETTING[1])))
    acts = F.concat(F.lit(ACTIONS[0]), delimiter, F.lit(ACTIONS[1]), delimiter, F.lit(ACTIONS[2]), delimiter)
    return F.when(delimiter == "", base).otherwise(F.concat(base, acts))


def open_chats(sessions: DataFrame, responder, setting: str, start: list[str], seed: int = 0) -> DataFrame:
    """Chats before their first answer: the setting is asked for, the action mark, the opening and the
    first speaker are drawn.

    sessions: (session, topic, cast: array of (name, description, hint), the user last), and where it
    is given ``first``, who speaks first.  setting: a template of characters and topic.
    """
    about = F.array_join(F.transform("cast", lambda c: F.concat(c["name"], F.lit(": "), c["description"])), "\n\n")
    asked = responder.respond(sessions, S.fill(setting, characters=about, topic=F.col("topic")), out="setting").where(~S.is_blank("setting"))
    even = lambda options, salt: sampling.weighted(options, [1] * len(options), seed + salt, "session")
    drawn = F.get("cast", F.floor(sampling.draw(seed + 1, "session") * F.size("cast")).cast("int"))["name"]
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("text"))
    chats = asked.withColumn("delimiter", even(DELIMITERS, 2)).withColumn("user", F.element_at("cast", -1)["name"])
    chats = chats.withColumn("turns", F.array(said("system", _system(F.col("delimiter"))), said("user", even(start, 3))))
    first = F.coalesce("first", drawn) if "first" in sessions.columns else drawn
    return chats.select("session", "topic", "cast", "user", "delimiter", first.alias("current"), "turns", F.lit(0).alias("answers"), F.lit(0).alias("rerolls"), F.lit(False).alias("done"))


def next_turn(chats: DataFrame, responder, rules: str, first: str, nudges: list[str], most: int, seed: int = 0, most_answers: int | None = None) -> DataFrame:
    """Every chat after one more answer of its current speaker.

    Templates: rules (name, user, others, hint), first (name), nudges (topic).  An answer that is
    missing or blank once it is cleaned counts as failed: a chat without any turn is given up, others
    ask again until ``REROLLS`` is passed.  A chat ends with ``most`` turns, system and opening
    included, or one earlier where the user is next; answers in a row of others than the user are one
    turn, so ``most_answers`` (by default 4 * most) ends chats that the user never gets into.
    """
    names = F.transform("cast", lambda c: c["name"])
    others = F.array_except(names, F.array("current"))
    hint = F.get(F.filter("cast", lambda c: c["name"] == F.col("current")), F.lit(0))["hint"]
    told = F.array_join(F.transform(F.slice("turns", 3, F.greatest(F.size("turns") - 2, F.lit(0))), lambda t: t["text"]), "\n\n")
    ruled = S.fill(rules, name=F.col("current"), user=F.col("user"), others=F.to_json(others), hint=hint)
    n = F.size("turns")
    drawn = sampling.weighted(list(range(len(nudges))), [1] * len(nudges), seed, "session", n)
    nudge = F.get(F.array(*[S.fill(x, topic=S.quoted("topic")) for x in nudges]), drawn)
    prompt = F.concat_ws("\n\n", F.get("turns", F.lit(0))["text"], ruled, F.when(n > 2, F.concat_ws("\n\n", told, nudge)).otherwise(S.fill(first, name=F.col("current"))))
    asked = responder.respond(chats, prompt, out="__answer", filtered=False)

    body, after = parsers.next_speaker("__answer", "current", "user", names, seed=seed)
    parsed = asked.withColumn("__body", body).withColumn("__next", after)
    tidy = F.col("__body")
    for d in filter(None, DELIMITERS):
        tidy = F.when(F.col("delimiter") == d, S.tidy_actions("__body", d)).otherwise(tidy)
    parsed = parsed.withColumn("__body", tidy).withColumn("__ok", ~S.is_blank("__answer") & ~S.is_blank("__body"))

    # whoever speaks first answers the opening
    role = F.when((F.col("current") == F.col("user")) & (n > 2), "user").otherwise("assistant")
    line = F.concat("current", F.lit(": "), "__body")
    last = F.element_at("turns", -1)
    joined = F.concat(F.slice("turns", 1, n - 1), F.array(F.struct(last["role"].alias("role"), F.concat(last["text"], F.lit("\n\n"), line).alias("text"))))
    more = F.concat("turns", F.array(F.struct(role.alias("role"), line.alias("text"))))
    added = F.when((role == "assistant") & (last["role"] == "assistant"), joined).otherwise(more)

    out = parsed.where(F.col("__ok") | (n > 2)).withColumn("__turns", F.when(F.col("__ok"), added).otherwise(F.col("turns")))
    full = (F.size("__turns") >= most) | ((F.col("__next") == F.col("user")) & (F.size("__turns") >= most - 1))
    answers = F.col("answers") + F.col("__ok").cast("int")
    done = F.when(F.col("__ok"), full | (answers >= (most_answers or 4 * most))).otherwise(F.col("rerolls") > REROLLS)
    rerolls = F.col("rerolls") + F.when(F.col("__ok"), 0).otherwise(1)
    speaker = F.when(F.col("__ok"), F.col("__next")).otherwise(F.col("current"))
    return out.select("session", "topic", "cast", "user", "delimiter", speaker.alias("current"), F.col("__turns").alias("turns"), answers.alias("answers"), rerolls.alias("rerolls"), done.alias("done"))


def chats(sessions: DataFrame, responder, setting: str, rules: str, first: str, start: list[str], nudges: list[str], most: int = 50, seed: int = 0, most_answers: int | None = None) -> DataFrame:
    """(session, turns) of all chats that got a first message; see ``open_chats`` and ``next_turn``."""
    open_ = cut(open_chats(sessions, responder, setting, start, seed))
    ended = open_.where("done").select("session", "turns")
    while not open_.isEmpty():
        now = cut(next_turn(open_, responder, rules, first, nudges, most, seed, most_answers))
        ended = ended.unionAll(now.where("done").select("session", "turns"))
        open_ = now.where("not done")
    return ended


def rows(ended: DataFrame) -> DataFrame:
    """Stored rows: one for each answer, whose instruction is all that was said before it."""
    long = ended.select("session", F.posexplode("turns").alias("turn", "t")).select("session", "turn", "t.role", "t.text")
    made = conversation.prefix_rows(long, "session")
    return made.select("session", "turn", F.lit("rp").alias("category"), "instruction", "response", "skip_counting", F.lit(True).alias("skip_prompt_formatting"))
