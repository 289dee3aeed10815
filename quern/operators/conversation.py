"""Conversations in long form (conversation, turn, role, text): checks, prompts, training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as S

OPENING = "A chat."


def _order(conv: str, turn: str):
    return Window.partitionBy(conv).orderBy(turn)


def valid(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """(conv, valid, n_turns): known roles only, and user and assistant alternate, the user first;
    a system message anywhere starts over. An end on either role is valid."""
    before = F.lag(role).over(_order(conv, turn))
    ok = F.when(F.col(role) == "system", True).when(F.col(role) == "user", before.isNull() | (before != "user")).when(F.col(role) == "assistant", F.coalesce(before == "user", F.lit(False))).otherwise(False)
    return df.withColumn("__ok", F.coalesce(ok, F.lit(False))).groupBy(conv).agg(F.bool_and("__ok").alias("valid"), F.count(F.lit(1)).alias("n_turns"))


def prompts(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, prompt): ``system``, then ``USER:``/``ASSISTANT:`` lines, then an open ``ASSISTANT: ``."""
    line = F.when(F.col(role) == "system", F.col(text)).otherwise(F.concat(F.upper(role), F.lit(": "), F.col(text)))
    said = df.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), line.alias("line")))).alias("m"))
    opening = F.when(F.get("m", F.lit(0))["r"] == "system", F.lit("")).otherwise(F.lit(OPENING + "\n"))
    return said.select(conv, F.concat(opening, F.array_join(F.transform("m", lambda x: x["line"]), "\n"), F.lit("\nASSISTANT: ")).alias("prompt"))


def messages(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, messages): the array form."""
    said = df.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("m"))
    return said.select(conv, F.transform("m", lambda x: F.struct(x["role"], x["content"])).alias("messages"))


def author_form(messages: Column) -> tuple[Column, Column]:
    """The other vendor's shape: (context: the system messages; messages as author and content)."""
    system = F.filter(messages, lambda m: m["role"] == "system")
    rest = F.filter(messages, lambda m: m["role"] != "system")
    context = F.array_join(F.transform(system, lambda m: m["content"]), "\n")
    return context, F.transform(rest, lambda m: F.struct(m["role"].alias("author"), m["content"]))


def prefix_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A training row for each assistant turn: the instruction is all that was said before it.

    Columns: conv, turn, instruction, response, skip_counting (all but a conversation's first row).
    Output grows with the square of a conversation's turns, as the format asks for.
    """
    before = Window.partitionBy(conv).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    system = F.array_join(F.collect_list(F.when(F.col(role) == "system", F.col(text))).over(before), "\n")
    said = F.array_join(F.collect_list(F.when(F.col(role) != "system", F.col(text))).over(before), "\n")
    earlier = F.sum(F.when(F.col(role) == "assistant", 1).otherwise(0)).over(before)
    rows = df.withColumn("instruction", F.concat(S.strip(F.concat_ws("\n", system, said)), F.lit("\n"))).withColumn("__e", F.coalesce(earlier, F.lit(0)))
    return rows.where(F.col(role) == "assistant").select(conv, turn, "instruction", F.col(text).alias("response"), (F.col("__e") > 0).alias("skip_counting"))


def exchanges(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, idx, user, assistant): each assistant turn that follows a user turn at once."""
    w = _order(conv, turn)
    pairs = df.withColumn("__r", F.lag(role).over(w)).withColumn("user", F.lag(text).over(w)).where((F.col(role) == "assistant") & (F.col("__r") == "user"))
    return pairs.select(conv, (F.row_number().over(w) - 1).alias("idx"), "user", F.col(text).alias("assistant"), turn).drop(turn)


def budgeted_rows(pairs: DataFrame, system_words: Column, most_words: int = 2500, conv: str = "conv_id") -> DataFrame:
    """Pairs that become rows under a budget of words: the system prompt and all pairs so far count,
    pairs after the first that goes over are gone; the first is context only, the last is never a
    row. Columns of ``pairs`` with ``words``, the running total."""
    w = Window.partitionBy(conv).orderBy("idx")
    last = F.max("idx").over(Window.partitionBy(conv))
    own = S.word_count("user") + S.word_count("assistant")
    rows = pairs.withColumn("words", F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, 0)) + system_words).withColumn("__last", last)
    return rows.where((F.col("words") <= most_words) & (F.col("idx") > 0) & (F.col("idx") < F.col("__last"))).drop("__last")


def merge_assistants(df: DataFrame, user: str, conv: str = "conv_id", turn: str = "turn", speaker: str = "speaker", text: str = "text") -> DataFrame:
    """Neighbouring turns of others than the user become one assistant turn.

    Columns: conv, turn (of the first), role, text (``speaker: text`` parts, blank line between).
    """
    w = _order(conv, turn)
    role = F.when(F.col(speaker) == user, F.lit("user")).otherwise(F.lit("assistant"))
    marked = df.withColumn("__role", role).withColumn("__new", ((F.col("__role") == "user") | F.coalesce(F.lag("__role").over(w) == "user", F.lit(True))).cast("int"))
    islands = marked.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.struct(F.col(turn).alias("t"), F.concat(F.col(speaker), F.lit(": "), F.col(text)).alias("x"))
    out = islands.groupBy(conv, "__island", "__role").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return out.select(conv, F.col("p")[0]["t"].alias(turn), F.col("__role").alias("role"), F.array_join(F.transform("p", lambda x: x["x"]), "\n\n").alias("text"))


def limited(df: DataFrame, most: int, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """The first ``most`` turns; one fewer where the user would be next."""
    w = _order(conv, turn)
    n, after = F.row_number().over(w), F.lead(role).over(w)
    rows = df.withColumn("__n", n).withColumn("__stop", (F.col("__n") >= most) | ((F.col("__n") >= most - 1) & F.coalesce(after == "user", F.lit(False))))
    stopped = F.coalesce(F.max(F.col("__stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__gone", stopped).where("__gone = 0").drop("__n", "__stop", "__gone")


def export(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, conversations): the human/gpt form, system messages left out."""
    said = df.where(F.col(role) != "system").groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), F.when(F.col(role) == "user", "human").otherwise("gpt").alias("from"), F.col(text).alias("value")))).alias("m"))
    return said.select(conv, F.transform("m", lambda x: F.struct(x["from"], x["value"])).alias("conversations"))


def usage(df: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, prompt_tokens, completion_tokens, total_tokens), in words; only generated text is completion."""
    n = S.word_count(text)
    made = F.sum(F.when(F.col(role) == "assistant", n).otherwise(0))
    asked = F.sum(F.when(F.col(role) != "assistant", n).otherwise(0))
    return df.groupBy(conv).agg(asked.alias("prompt_tokens"), made.alias("completion_tokens")).withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def completion(response: Column, model: Column, usage: Column) -> Column:
    """The nested answer of a completion request as JSON."""
    choice = F.struct(F.lit(0).alias("index"), F.struct(F.lit("assistant").alias("role"), S.strip(response).alias("content")).alias("message"), F.lit("stop").alias("finish_reason"))
    return F.to_json(F.struct(F.lit("chat.completion").alias("object"), model.alias("model"), F.array(choice).alias("choices"), usage.alias("usage")))


def deltas(df: DataFrame, group: str, seq: str, text: str) -> DataFrame:
    """``delta``: what each growing text adds to the one before it in its group."""
    before = F.lag(text).over(Window.partitionBy(group).orderBy(seq))
    return df.withColumn("delta", F.substr(F.col(text), F.coalesce(F.length(before), F.lit(0)) + 1))
