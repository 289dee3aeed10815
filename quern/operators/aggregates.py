"""Counts, group lists, weighted means and group winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as S
from .sampling import numbered_in_ranges


def category_counts(df: DataFrame, category: str = "category", counted: Column | None = None) -> DataFrame:
    """Rows per category; only rows for which ``counted`` holds. Null categories count as general."""
    keep = F.coalesce(counted, F.lit(True)) if counted is not None else F.lit(True)
    return df.groupBy(F.coalesce(F.col(category), F.lit("general")).alias(category)).agg(F.count_if(keep).alias("count"))


def running_counts(df: DataFrame, category: str, order: str) -> DataFrame:
    """``running_count``: how many rows of the category there are up to a row, in the order of a key.
    Rows are counted in ranges, which are then added up, so no task holds a whole category."""
    numbered, at, _ = numbered_in_ranges(df, category, order)
    return numbered.withColumn("running_count", at + 1).select(*[F.col(f"`{c}`") for c in df.columns], "running_count")


def weighted_centroid(df: DataFrame, by: str, vector: str, weight: Column, places: int = 6) -> DataFrame:
    """(by, pos, value): the weighted mean of each group's vectors, brought to unit length."""
    parts = df.select(by, weight.alias("w"), F.posexplode(vector).alias("pos", "v"))
    mean = parts.groupBy(by, "pos").agg((F.sum(F.col("w") * F.col("v").cast("double")) / F.sum("w")).alias("m"))
    norms = mean.groupBy(by).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"))
    return mean.join(norms, by).select(by, "pos", F.round(F.col("m") / F.col("norm"), places).alias("value"))


def longest(df: DataFrame, by: list, size: Column, order: str) -> DataFrame:
    """Per group the row of the greatest size, the last in order among equal ones: (by, order)."""
    return df.groupBy(*by).agg(F.max_by(order, F.struct(size, F.col(order))).alias(order), F.count(F.lit(1)).alias("members"))


def first_by_text(df: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of each text, without case and surrounding white space."""
    salted = df.withColumn("__t", F.lower(S.strip(text)))
    first = salted.groupBy("__t").agg(F.min(order).alias("__o"))
    return salted.join(first, (salted["__t"] == first["__t"]) & (F.col(order) == F.col("__o"))).drop("__o").drop("__t")


def grouped_lists(df: DataFrame, by: str, order: str, item: Column) -> DataFrame:
    """(by, items): each group's items in order."""
    held = df.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))).alias("x"))
    return held.select(by, F.transform("x", lambda x: x["i"]).alias("items"))


def after_marker(df: DataFrame, category: str, order: str, line: str, state: DataFrame) -> DataFrame:
    """Rows after the last written one of each category. state: (category, line); a marker that does
    not occur skips nothing."""
    marks = state.select(F.col(category).alias("__c"), F.col(line).alias("__l"))
    at = df.join(marks, (F.col(category) == F.col("__c")) & (F.col(line) == F.col("__l"))).groupBy("__c").agg(F.max(order).alias("__at"))
    return df.join(at, F.col(category) == F.col("__c"), "left").where(F.col("__at").isNull() | (F.col(order) > F.col("__at"))).drop("__c", "__at")
