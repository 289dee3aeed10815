"""Exact deduplication by sorting contents.

Texts without white space are range-partitioned by sampled splitters (Spark samples the sort keys), sorted
inside their partitions (which spills to disk), and neighbours are compared in full, where a window's
group ends.  What is sampled is bounded: the keys of the splitters are a text's first 32 characters and
a hash of all of it, so that neither long texts nor a common beginning upset the ranges; rows of equal keys
are then told apart by their whole texts.

A text of so many copies that they would fill a good part of a range is cut into several groups,
by a salt in the key; the heads of these groups, a bounded number, are compared in full again.
Everything is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .workspace import release, stage

# The characters that do not count, as in [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def classes(df: DataFrame, id: str = "doc_id", text: str = "text", carry: list[Column] | None = None, share: int = 4) -> DataFrame:
    """One row for each row of ``df``: (id, keep_id, group_size, kept, text_sha256), and a struct ``row``
    of the columns ``carry`` where there are any.

    Texts are equal if they are so without white space; null counts as empty, and empty texts are equal.
    Of equal texts the row with the most characters (white space counts) stays, then that with the
    least id; null ids come last, so ``keep_id`` is null only if all the longest rows' ids are.  Of rows
    equal in both, exactly one is ``kept``.  Very long texts are compared whole.  An empty table gives an
    empty one.  No other column of ``df`` is looked at, so their names may clash with those used here.

    A text is hot if its copies are more than 1 / (``share`` * partitions) of all rows: at most ``share``
    * partitions texts are, and only they are salted, and broadcast.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = normalised(df[text])
    wanted = [df[id].alias("id"), norm.alias("norm"), F.length(F.coalesce(df[text], F.lit(""))).alias("size"), *([F.struct(*carry).alias("row")] if carry else [])]
    texts = stage(df.select(*wanted).withColumn("h", F.xxhash64("norm")), "content")
    total = texts.count()
    counts = texts.groupBy("h").count().where(F.col("count") * (share * parts) > total)
    hot = stage(counts.select("h", F.ceil(F.col("count") * (share * parts) / max(total, 1)).cast("int").alias("salts")).coalesce(1), "content-hot")

    # the partition's number also tells apart rows whose ids are equal
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("id", F.spark_partition_id()), F.col("salts"))).otherwise(0).cast("int")
    keyed = texts.join(F.broadcast(hot), "h", "left").withColumn("salt", salt).withColumn("start", F.substring("norm", 1, 32))
    ranged = keyed.repartitionByRange("start", "h", "salt")
    same = Window.partitionBy("start", "h", "salt", "norm")
    first = same.orderBy(F.desc("size"), F.asc_nulls_last("id"))
    is_hot = F.col("salts").isNotNull()
    grouped = ranged.select(
        "*",
        F.row_number().over(first).alias("n"),
        F.first("id").over(first).alias("best"),
        F.first("size").over(first).alias("most"),
        F.count(F.lit(1)).over(same).alias("members"),
    )
    carried = ["row"] if carry else []
    found = stage(grouped.select("id", "best", "most", "members", "n", "salt", is_hot.alias("hot"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), F.when(is_hot & (F.col("n") == 1), F.col("norm")).alias("head"), *carried), "content-groups")
    release(texts, hot)

    # one head for each salt of a hot text; no more than (share * partitions) texts in all
    order = F.struct((-F.col("most")).alias("most"), F.col("best").isNull().alias("missing"), F.col("best").alias("best"), F.col("salt").alias("salt"))
    heads = found.where(F.col("head").isNotNull()).groupBy("head").agg(F.min(order).alias("x"), F.sum("members").alias("all"), F.first("text_sha256").alias("digest"))
    heads = heads.select("digest", "all", F.col("x.best").alias("winner"), F.col("x.salt").alias("won"))
    joined = found.drop("head").join(F.broadcast(heads), F.when(F.col("hot"), F.col("text_sha256")) == F.col("digest"), "left")
    return joined.select(
        "id",
        F.when(F.col("hot"), F.col("winner")).otherwise(F.col("best")).alias("keep_id"),
        F.when(F.col("hot"), F.col("all")).otherwise(F.col("members")).alias("group_size"),
        ((F.col("n") == 1) & (~F.col("hot") | (F.col("salt") == F.col("won")))).alias("kept"),
        "text_sha256",
        *carried,
    )


def keep_first(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with its columns: one of each class of equal texts."""
    carry = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    found = classes(df, id, text, carry).where("kept")
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(df.columns)])
