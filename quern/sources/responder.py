"""Language models as a pluggable responder: prompts in, texts or null out.  No network calls."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import filters


class TableResponder:
    """Answers from a table (prompt_hash, text, finish_reason): deterministic, joinable, testable."""

    def __init__(self, table: DataFrame):
        self.table = table.select("prompt_hash", F.col("text").alias("__text"), F.col("finish_reason").alias("__finish"))

    def respond(self, df: DataFrame, prompt: Column, out: str = "response", filtered: bool = True, strip: bool = False) -> DataFrame:
        joined = df.withColumn("__h", F.md5(prompt)).join(self.table, F.col("__h") == F.col("prompt_hash"), "left")
        return joined.withColumn(out, accepted(F.col("__text"), F.col("__finish"), filtered, strip)).drop("__h", "prompt_hash", "__text", "__finish")


class ExpressionResponder:
    """Answers as an expression of the prompt: rules in the place of a model, for tests and queries."""

    def __init__(self, answer: Callable[[Column], Column]):
        self.answer = answer

    def respond(self, df: DataFrame, prompt: Column, out: str = "response", filtered: bool = True, strip: bool = False) -> DataFrame:
        # prompt and answer are variables of lambdas, so that chains of answers do not repeat expressions
        bound = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
        return df.withColumn(out, bound(prompt, lambda p: bound(self.answer(p).cast("string"), lambda t: accepted(t, F.lit("stop"), filtered, strip))))


class FunctionResponder:
    """Answers from a function of one prompt, run in Arrow batches.

    Exceptions of the kinds ``missing`` are tried again, ``attempts`` times in all with Fibonacci waits
    between, and are then a missing answer; others are errors of the program and end the job.
    """

    def __init__(self, function: Callable[[str], str | None], missing: tuple = (OSError,), attempts: int = 1, wait: Callable[[float], None] = time.sleep):
        self.function, self.missing, self.attempts, self.wait = function, missing, attempts, wait

    def respond(self, df: DataFrame, prompt: Column, out: str = "response", filtered: bool = True, strip: bool = False) -> DataFrame:
        function, missing, wait = self.function, self.missing, self.wait
        waits = backoff_seconds()
        waits = [waits[min(i, len(waits) - 1)] for i in range(self.attempts - 1)]

        @F.pandas_udf("string")
        def call(prompts: pd.Series) -> pd.Series:
            def one(p):
                for pause in [*waits, None]:
                    try:
                        return function(p)
                    except missing:
                        if pause is not None:
                            wait(pause)
                return None

            return prompts.map(one)

        return df.withColumn("__text", call(prompt)).withColumn(out, accepted(F.col("__text"), F.lit("stop"), filtered, strip)).drop("__text")


class Limited(Exception):
    """The service asks to wait: tried again after a pause."""


class TooLong(Exception):
    """The prompt or the answer is too long: no use in trying again."""


class Rejected(Exception):
    """The service refuses the prompt: no use in trying again."""


class Pace:
    """A token bucket: ``rate`` calls a second on average, ``burst`` at once."""

    def __init__(self, rate: float | None, burst: int, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        import threading

        self.rate, self.room, self.burst, self.clock, self.wait = rate, float(burst), burst, clock, wait
        self.at, self.lock = clock(), threading.Lock()

    def take(self) -> None:
        if self.rate is None:
            return
        with self.lock:
            now = self.clock()
            self.room = min(self.burst, self.room + (now - self.at) * self.rate) - 1
            self.at = now
            pause = max(0.0, -self.room / self.rate)
        if pause:
            self.wait(pause)


class ConcurrentResponder:
    """Answers from a function of one prompt, several calls at a time, kept in a durable table.

    A task has ``open_calls`` calls under way at most, and starts ``rate`` a second (for each task; ``tasks``
    bounds how many there are, so the service sees tasks * open_calls and tasks * rate at most).
    ``Limited`` and errors of the kinds ``missing`` are tried again, ``attempts`` times in all, with Fibonacci waits;
    ``TooLong`` ends in the finish reason ``length`` and ``Rejected`` in ``rejected``, both without an
    answer; other errors end the job.

    Answers are stored below ``path`` as (prompt_hash, text, finish_reason), a folder for each call of
    ``respond`` and file for each slice of prompts.  Prompts with a stored answer are not asked again, whatever
    run they were asked in; equal prompts are asked once.  Prompts are asked in ``slices`` jobs one after the other,
    so a job that fails loses the answers of its own slice only; missing answers are not stored.
    """

    def __init__(self, function: Callable[[str], str | None], path: str, open_calls: int = 8, rate: float | None = None, tasks: int = 8, slices: int = 4, missing: tuple = (OSError,), attempts: int = 5, wait: Callable[[float], None] = time.sleep):
        self.function, self.path, self.open_calls, self.rate, self.tasks, self.slices = function, path, open_calls, rate, tasks, slices
        self.missing, self.attempts, self.wait = missing, attempts, wait

    def answers(self, spark) -> DataFrame:
        """All stored answers, one for each prompt."""
        schema = "prompt_hash string, text string, finish_reason string"
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.createDataFrame([], schema)
        held = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(self.path)
        return held.groupBy("prompt_hash").agg(F.min_by(F.struct("text", "finish_reason"), F.xxhash64("text", "finish_reason")).alias("a")).select("prompt_hash", "a.*")

    def ask(self, prompts: DataFrame) -> None:
        """Stores answers to (prompt_hash, prompt): each once, those that have none yet."""
        spark = prompts.sparkSession
        function, missing, attempts, wait, rate, many = self.function, self.missing, self.attempts, self.wait, self.rate, self.open_calls
        waits = backoff_seconds()

        def one(pace: Pace, prompt: str) -> tuple[str | None, str | None]:
            for i in range(attempts):
                try:
                    pace.take()
                    text = function(prompt)
                    return text, None if text is None else "stop"
                except TooLong:
                    return None, "length"
                except Rejected:
                    return None, "rejected"
                except (Limited, *missing):
                    if i + 1 < attempts:
                        wait(waits[min(i, len(waits) - 1)])
            return None, None

        def run(batches):
            from concurrent.futures import ThreadPoolExecutor

            pace = Pace(rate, many)
            with ThreadPoolExecutor(many) as pool:
                for batch in batches:
                    got = list(pool.map(lambda p: one(pace, p), batch["prompt"]))
                    out = pd.DataFrame({"prompt_hash": batch["prompt_hash"].to_numpy(), "text": [g[0] for g in got], "finish_reason": [g[1] for g in got]}, dtype=object)
                    yield out[out["finish_reason"].notna()]

        part = F.pmod(F.xxhash64("prompt_hash"), F.lit(self.slices))
        for i in range(self.slices):
            todo = prompts.where(part == i).dropDuplicates(["prompt_hash"]).join(self.answers(spark).select("prompt_hash"), "prompt_hash", "left_anti")
            if todo.isEmpty():
                continue
            asked = todo.repartition(self.tasks, "prompt_hash").mapInPandas(run, "prompt_hash string, text string, finish_reason string")
            asked.write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def respond(self, df: DataFrame, prompt: Column, out: str = "response", filtered: bool = True, strip: bool = False) -> DataFrame:
        asked = df.select(prompt.alias("prompt")).where("prompt is not null")
        self.ask(asked.select(F.md5("prompt").alias("prompt_hash"), "prompt"))
        return TableResponder(self.answers(df.sparkSession)).respond(df, prompt, out, filtered, strip)


def accepted(text: Column, finish: Column, filtered: bool, strip: bool) -> Column:
    """The text, or null where it is missing, cut off, banned or an apology."""
    from ..functions.text import strip as stripped

    ok = ~filters.is_cut(finish) & text.isNotNull()
    if filtered:
        ok = ok & ~filters.is_banned(text) & ~filters.is_apology(text)
    return F.when(ok, stripped(text) if strip else text)


def backoff_seconds(most: int = 19) -> list[int]:
    """Fibonacci waits up to a ceiling, for responders that retry."""
    a, b, out = 1, 1, []
    while a <= most:
        out.append(a)
        a, b = b, a + b
    return [*out, most] if out and out[-1] < most else out
