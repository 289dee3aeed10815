"""The concurrent responder: calls are counted in files, as they are made in other processes."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from quern.sources import responder as R


def counted(folder, answer):
    """Writes a file for each call, then answers."""

    def call(prompt):
        with open(os.path.join(folder, f"{prompt}-{uuid.uuid4().hex}"), "w"):
            pass
        return answer(prompt)

    return call


def calls(folder):
    out = {}
    for name in os.listdir(folder):
        key = name.rpartition("-")[0]
        out[key] = out.get(key, 0) + 1
    return out


def test_each_prompt_is_asked_once_and_never_again(spark, tmp_path):
    os.makedirs(seen := str(tmp_path / "calls"))
    flaky = str(tmp_path / "flaky")

    def answer(prompt):
        if prompt == "p3" and not os.path.exists(flaky):
            open(flaky, "w").close()
            raise R.Limited("slow down")
        if prompt == "p4":
            raise R.TooLong("no")
        if prompt == "p5":
            raise R.Rejected("no")
        if prompt == "p6":
            raise OSError("gone")
        return f"answer to {prompt}"

    model = R.ConcurrentResponder(counted(seen, answer), str(tmp_path / "answers"), open_calls=3, tasks=2, slices=2, attempts=3, wait=lambda s: None)
    df = spark.range(20).select(F.col("id"), F.concat(F.lit("p"), (F.col("id") % 10).cast("string")).alias("prompt"))
    df = df.unionAll(spark.createDataFrame([(99, None)], "id bigint, prompt string"))
    got = {r["id"]: r["response"] for r in model.respond(df, F.col("prompt")).collect()}
    assert len(got) == 21 and all(got[i] == (None if i % 10 in (4, 5, 6) else f"answer to p{i % 10}") for i in range(20)) and got[99] is None
    assert calls(seen) == {f"p{i}": {3: 2, 6: 3}.get(i, 1) for i in range(10)}
    kept = {r["finish_reason"]: r["count"] for r in model.answers(spark).groupBy("finish_reason").count().collect()}
    assert kept == {"stop": 7, "length": 1, "rejected": 1}
    # only the one without an answer is asked again
    model.respond(df, F.col("prompt")).collect()
    assert calls(seen) == {f"p{i}": {3: 2, 6: 6}.get(i, 1) for i in range(10)}


def test_answers_of_finished_slices_survive_a_failed_job(spark, tmp_path):
    os.makedirs(seen := str(tmp_path / "calls"))
    broken = str(tmp_path / "broken")
    open(broken, "w").close()
    part = {r["p"]: r["i"] for r in spark.range(12).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("p")).select("p", F.pmod(F.xxhash64(F.md5("p")), F.lit(3)).alias("i")).collect()}
    last = next(p for p, i in part.items() if i == 2)

    def answer(prompt):
        if prompt == last and os.path.exists(broken):
            raise ValueError("an error of the program")
        return "yes"

    df = spark.createDataFrame([(p,) for p in part], "prompt string")
    model = R.ConcurrentResponder(counted(seen, answer), str(tmp_path / "answers"), open_calls=2, tasks=1, slices=3)
    with pytest.raises(Exception, match="an error of the program"):
        model.respond(df, F.col("prompt")).collect()
    os.remove(broken)
    assert {r["response"] for r in model.respond(df, F.col("prompt")).collect()} == {"yes"}
    again = {p for p, n in calls(seen).items() if n > 1}
    assert again <= {p for p, i in part.items() if i == 2} and last in again


def test_calls_are_open_together_and_paced(spark, tmp_path):
    model = R.ConcurrentResponder(lambda p: time.sleep(0.5) or "x", str(tmp_path / "a"), open_calls=16, tasks=1, slices=1)
    df = spark.range(16).select(F.col("id").cast("string").alias("p"))
    start = time.time()
    model.ask(df.select(F.md5("p").alias("prompt_hash"), F.col("p").alias("prompt")))
    assert model.answers(spark).count() == 16 and time.time() - start < 60
    now, waited = [0.0], []
    pace = R.Pace(2.0, 3, clock=lambda: now[0], wait=lambda s: (waited.append(round(s, 6)), now.__setitem__(0, now[0] + s)))
    for _ in range(6):
        pace.take()
    # three at once, then one each half second
    assert waited == [0.5, 0.5, 0.5]
