import numpy as np
from pyspark.sql import functions as F

from quern.operators import aggregates, conversation, sampling


def rows(spark, n=500):
    return spark.range(n).select(F.col("id"), (F.col("id") % 7).cast("string").alias("c"))


def test_samples_agree_with_themselves(spark):
    df = rows(spark)
    a = [r["id"] for r in sampling.sample(df, 50, "id", 3).collect()]
    assert len(set(a)) == 50 and a == [r["id"] for r in sampling.sample(df.repartition(9), 50, "id", 3).collect()]
    assert sampling.sample(df, 600, "id", 3).count() == 600
    assert [r["id"] for r in sampling.shuffled(df, "id", 1).collect()] != list(range(500))
    u = [r[0] for r in df.select(sampling.draw(1, "id")).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.05
    w = [r[0] for r in spark.range(5000).select(sampling.weighted([2, 3, 4], [0.85, 0.12, 0.03], 1, "id")).collect()]
    assert abs(w.count(2) / 5000 - 0.85) < 0.02 and w.count(4) > 50


def test_groups(spark):
    df = rows(spark)
    assert {r["count"] for r in sampling.take_per_group(df, ["c"], F.lit(5), "id", 2).groupBy("c").count().collect()} == {5}
    assert sorted(r["id"] for r in sampling.take_per_group(df, ["c"], F.lit(2), "id").collect()) == list(range(14))
    have = spark.createDataFrame([("0", 3), ("1", 9)], "c string, count bigint")
    got = {r["c"]: r["count"] for r in sampling.quota(df, "c", "id", F.lit(5), have).groupBy("c").count().collect()}
    assert got == {"0": 2, "2": 5, "3": 5, "4": 5, "5": 5, "6": 5}
    assert sampling.stratified(df.where("id < 7"), "c", "id").count() == 7


def test_draws_with_replacement_are_even(spark):
    times = [r["count"] for r in sampling.sample(rows(spark, 50), 5000, "id", 3).groupBy("id").count().collect()]
    # chi-square of 49 degrees of freedom: 85 at a chance of 0.001
    assert len(times) == 50 and sum((x - 100) ** 2 / 100 for x in times) < 85


def test_buckets_that_are_open_are_equally_likely(spark):
    # a bucket of 400 rows, one of 100 and one of 3
    df = spark.range(503).select("id", F.when(F.col("id") < 400, "a").when(F.col("id") < 500, "b").otherwise("c").alias("c"))
    first = {"a": 0, "b": 0, "c": 0}
    for seed in range(30):
        got = sampling.bucket_pop(df, "c", "id", 4, seed).orderBy("turn").collect()
        assert [r["turn"] for r in got] == [0, 1, 2, 3] and len({r["id"] for r in got}) == 4
        for r in got[:3]:
            first[r["c"]] += 1
    assert sum((x - 30) ** 2 / 30 for x in first.values()) < 13.8
    whole = sampling.bucket_pop(df, "c", "id", 600, 1)
    assert whole.count() == 503 and whole.select("id").distinct().count() == 503


def test_batches_as_array_split(spark):
    for n, size in ((10, 3), (12, 4), (1, 5), (23, 7)):
        df = spark.range(n).withColumn("g", F.lit("x"))
        got = {}
        for r in sampling.batches(df, "id", size, "g").collect():
            got.setdefault(r["batch"], []).append(r["id"])
        want = np.array_split(np.arange(n), -(-n // size))
        assert [sorted(got[i + 1]) for i in range(len(want))] == [w.tolist() for w in want]


def test_running_total(spark):
    df = spark.range(300).withColumn("n", F.col("id") % 5)
    got = {r["id"]: r["running"] for r in sampling.running_total(df, "n", "id", 7).collect()}
    assert [got[i] for i in range(300)] == np.cumsum([i % 5 for i in range(300)]).tolist()
    assert sampling.until_exhausted(df, "n", "id", 20).count() == 11


def test_markers_and_counts(spark):
    df = spark.createDataFrame([(i, c, f"{c}{i}") for i in range(6) for c in "ab"], "o int, category string, line string")
    state = spark.createDataFrame([("a", "a3"), ("b", "gone")], "category string, line string")
    left = aggregates.after_marker(df, "category", "o", "line", state).groupBy("category").count().collect()
    assert {r["category"]: r["count"] for r in left} == {"a": 2, "b": 6}
    n = aggregates.category_counts(spark.createDataFrame([(None,), ("x",), ("general",)], "category string")).collect()
    assert {r["category"]: r["count"] for r in n} == {"general": 2, "x": 1}


def test_conversations(spark):
    said = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "system", "s"), (2, 1, "user", "a"), (2, 2, "assistant", "b"), (2, 3, "system", "s2"), (2, 4, "user", "c"), (3, 0, "assistant", "x"), (4, 0, "robot", "x"), (5, 0, None, "x")]
    df = spark.createDataFrame(said, "conv_id int, turn int, role string, text string")
    assert {r["conv_id"]: r["valid"] for r in conversation.valid(df).collect()} == {1: False, 2: True, 3: False, 4: False, 5: False}
    p = {r["conv_id"]: r["prompt"] for r in conversation.prompts(df).collect()}
    assert p[1] == "A chat.\nUSER: a\nUSER: b\nASSISTANT: " and p[2].startswith("s\nUSER: a\nASSISTANT: b\ns2\nUSER: c\n")
    j = spark.range(1).select(conversation.completion(F.lit(" hi "), F.lit("m"), F.struct(F.lit(1).alias("prompt_tokens"))).alias("j")).first()["j"]
    assert '"content":"hi"' in j and '"prompt_tokens":1' in j
