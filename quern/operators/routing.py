"""Routing queries to experts by the average distance of their nearest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parsers import function_name
from .similarity import nearest

DEFAULT_EXPERT = "reasoning"


def route(queries: DataFrame, table: DataFrame, k: int, key: str, vector: str, table_key: str, expert: str) -> DataFrame:
    """(key, expert, score): for each query the expert whose ``k`` nearest rows (all, if it has
    fewer) are closest on average; ties go to the first expert by name."""
    near = nearest(queries, table, k, key, vector, table_key, expert)
    score = near.groupBy("key", "group").agg(F.avg("distance").alias("score"))
    best = score.groupBy("key").agg(F.min(F.struct("score", "group")).alias("best"))
    return best.select(F.col("key").alias(key), F.col("best.group").alias("expert"), F.col("best.score").alias("score"))


def agent_choice(response, experts: list[str], default: str = DEFAULT_EXPERT) -> Column:
    """The expert that an agent's answer names; the default where it names none that exists."""
    named = function_name(response, experts)
    return F.when(named.isin(*experts), named).otherwise(F.lit(default))


def routing_text(system, instruction) -> Column:
    """What is embedded for routing: the system prompt, or a plain opening, and the instruction."""
    return F.concat_ws(" ", F.coalesce(F.col(system), F.lit("A chat.")), F.col(instruction))


def sampled(table: DataFrame, expert: str, key: str, most: int = 500, seed: int = 0) -> DataFrame:
    """``most`` rows of each expert, picked by a hash (a sampling operator)."""
    from .sampling import take_per_group

    return take_per_group(table, [expert], F.lit(most), key, seed)
