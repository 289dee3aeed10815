DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls in every column, empty and blank texts, repeated rows, and a very long text.
LONG = ("lorem ipsum dolor sit amet " * 20_000).strip()
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "en", "b", 4),
    (None, "an id that is null but words that are not", "en", "b", 5),
    (6, LONG, "la", "c", len(LONG)),
    (7, "ÄÖÜ ß straße 日本語 🙂 1234", "de", "é", 10),
]


def docs(spark, rows=EDGE):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return docs(spark, [])


def clashing(df, *names):
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in names})
