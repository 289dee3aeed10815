"""A training corpus from ``documents``: language, near duplicates, benchmark passages, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's result to
the shared folder and reads it again for the next.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, langid, mixing, near_dup, sharding
from quern.llm.workspace import fresh, stage

SHARDS = [f"shard-{i:03d}" for i in range(64)]


#: Least share of a document's words that must be known in the learned languages.
LEAST_KNOWN = 0.7


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in the languages learned from the labelled documents: those of whose words
    ``LEAST_KNOWN`` or more are known to the model, as words or by their n-grams.

    The score decides nothing, as a text in two learned languages has a low one.  Null texts and
    texts without a letter go; very short and very long ones are judged like others.  Repeated rows
    are judged alike; other columns are kept as they are.  Where no document has a language, nothing
    is known and all go; an empty table gives an empty one.
    """
    model = langid.train(docs, "text", "lang")
    pred, score, known = fresh(docs.columns, "__pred", "__score", "__known")
    found = langid.predict(docs, F.col("text"), model, [F.col(f"`{c}`") for c in docs.columns], pred, score, known)
    return found.where((F.col(pred) != langid.UNKNOWN) & (F.col(known) >= LEAST_KNOWN)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class (shingles of five words, similarity 0.8);
    texts without words are linked with nothing and stay, as do rows with a null id."""
    return near_dup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item, up to the edit budget. Null and empty texts stay, very
    long ones are searched whole, repeated rows are judged alike, columns stay as they are."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    (row,) = fresh(docs.columns, "__row")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)
    found = decontaminate.contaminated(docs, F.col("text"), items, [whole])
    return found.where(F.size("found") == 0).select(*[F.col(row)[c].alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row is a stretch of a document in a block of the mix. Blocks are written
    in order, whole output shards to a file, so the rows of a block follow each other. Documents
    without words are in no block; see ``mixed_documents`` for nulls and repeated rows."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every row by its document's id: the columns of ``docs`` with ``slot`` and ``shard``,
    which replace columns of those names. Null ids are one key, repeated rows stay repeated."""
    return sharding.place(docs, "doc_id", SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixture", mixture), ("shards", shards)]

#: SQL cannot express the language and mixture stages; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
