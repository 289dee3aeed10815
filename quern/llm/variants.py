"""Spelling variants: each word's nearest more frequent word, at one edit, without pairs of words.

*Replacements.*  A word of n characters is in n groups, one for each position: (position, prefix, suffix).
Two words meet in a group exactly if they differ in that position alone, and in one group at most.  A
group keeps its size and its two first words by frequency: of every member all other members are
near, and the best of them is the first word, or the second for the first word itself.

*Insertions and deletions.*  The distinct texts that a word leaves when a character is deleted are joined with
the vocabulary: a hit is near the word, and the word is near the hit.

Both are added up per word.  A group has no more members than there are letters, and a word no more
deletions than characters, so nothing grows with the square of anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .workspace import release, stage

# The letters of runs, and those that are lower-cased.
RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column, least: int) -> Column:
    """Array of the maximal runs of letters of ``least`` characters and more, A-Z in lower case."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    return F.transform(found, lambda x: F.translate(x, UPPER, LOWER))


def without(word: Column, at: Column) -> Column:
    """The word without the character at ``at`` (from 0)."""
    return F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))


def damaged(id: Column, run: Column, one_in: int = 31) -> Column:
    """The run, of which one character is deleted where ``one_in`` divides the checksum of ``id:run``
    (a null id is written as nothing)."""
    h = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    return F.when(h % one_in == 0, without(run, (h % F.length(run)).cast("int"))).otherwise(run)


def vocabulary(df: DataFrame, words: Column, least: int = 7, occurrences: int = 2) -> DataFrame:
    """(word, n) of the words of at least ``least`` characters that occur at least ``occurrences``
    times in the arrays ``words`` of all rows."""
    each = df.select(F.explode(words).alias("word")).where(F.length("word") >= least)
    return each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def _deletions(words: DataFrame) -> DataFrame:
    """(word, n, at, rest): each word without the character at each position."""
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("at"))
    return at.withColumn("rest", without(F.col("word"), F.col("at")))


def _best(word, n) -> Column:
    """The order of near words, first ones least: more frequent ones, then by code point."""
    return F.struct((-F.col(n)).alias("less"), F.col(word).alias("word"))


def near(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of the words that have near ones: how many, and the struct of the best.

    words: (word, n), each word once, no null or empty ones.
    """
    cut = _deletions(words)
    # the rest and the position are the prefix and the suffix
    group = Window.partitionBy("at", "rest")
    whole = group.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = lambda i: F.nth_value(F.struct((-F.col("n")).alias("less"), F.col("word").alias("word")), i).over(whole)
    members = cut.select("word", F.count(F.lit(1)).over(group).alias("members"), top(1).alias("first"), top(2).alias("second")).where("members > 1")
    replaced = members.select("word", (F.col("members") - 1).alias("n_near"), F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first")).alias("best"))

    # of a run of equal characters any one leaves the same rest: the first stands for all
    once = F.col("at") == 0
    again = F.substr("word", F.col("at"), F.lit(1)) == F.substr("word", F.col("at") + 1, F.lit(1))
    distinct = cut.where(once | ~again).select("word", "n", "rest")
    hits = distinct.join(words.select(F.col("word").alias("rest"), F.col("n").alias("rest_n")), "rest")
    both = F.array(
        F.struct(F.col("word"), _best("rest", "rest_n").alias("best")),
        F.struct(F.col("rest").alias("word"), _best("word", "n").alias("best")),
    )
    indels = hits.select(F.explode(both).alias("x")).select("x.word", F.lit(1).cast("bigint").alias("n_near"), "x.best")
    return replaced.unionAll(indels).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form: each word once, no cycles) ends.

    Each round follows one more form of all words that still have one; a form is ``ratio`` times as frequent
    as its word, so there are no more rounds than the largest count has digits, at a ratio of 10.
    """
    done, open_ = None, stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = open_.join(forms.select(F.col("word").alias("root"), F.col("form").alias("next")), "root", "left")
        step = stage(step, "roots")
        release(open_)
        ended = step.where("next is null").select("word", "root")
        done = ended if done is None else done.unionAll(ended)
        open_ = stage(step.where("next is not null").select("word", F.col("next").alias("root")), "roots")
        if open_.isEmpty():
            return done


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n), each word once.

    A word's form is its near word (one character inserted, deleted or replaced) of the largest n, ties
    by code point, if that n is at least ``ratio`` times the word's own; its root is where its forms end, the
    word itself if it has none.  Null and empty words are left out; an empty vocabulary gives an empty
    table; other columns of ``words`` are not looked at.
    """
    known = stage(words.where("word <> ''").select("word", F.col("n").cast("bigint").alias("n")), "words")
    held = known.join(near(known), "word", "left")
    fits = -F.col("best.less") >= F.col("n") * ratio
    table = stage(held.select("word", F.when(fits, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, -F.col("best.less")).alias("form_n")), "variants")
    release(known)
    ends = roots(table.where("form is not null").select("word", "form"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
