"""Streams with state of their own: growing texts to deltas under a budget, near deduplication by buckets.

State lives in Spark's state store under the query's checkpoint, so a batch costs what its own keys
hold, whatever has gone before, and a restart goes on where the last one ended.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.similarity import greedy_dedup

# Fixed value: what ends a stream of deltas.
DONE = "[DONE]"
WORDS = re.compile(r"[\w'-]+")


def use_state_store(spark: SparkSession) -> None:
    """State of processors needs the store that keeps columns apart; it is set unless one is chosen."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(name):
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


# ---- growing texts -----------------------------------------------------------------------------


class _Deltas(StatefulProcessor):
    """Per key: how much of the text is sent, how many words, and whether the key is closed."""

    def __init__(self, names: tuple[str, ...], budget: int | None, idle_ms: int | None):
        self.names, self.budget, self.idle_ms = names, budget, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.sent = handle.getValueState("sent", "size bigint, words bigint, last bigint, closed boolean")

    def _rows(self, key, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame([(key[0], *r) for r in rows], columns=list(self.names))

    def handleInputRows(self, key, rows, timerValues):
        size, words, last, closed = self.sent.get() if self.sent.exists() else (0, 0, -1, False)
        held = pd.concat(list(rows)).sort_values("seq", kind="stable")
        out = []
        for seq, text, finish in zip(held["seq"], held["text"], held["finish"], strict=True):
            if closed:
                break
            last = int(seq)
            if isinstance(text, str):
                delta = text[size:]
                n = len(WORDS.findall(delta))
                if self.budget is not None and words + n > self.budget:
                    closed = True
                    out.append((last, DONE, "", "budget"))
                    break
                size, words = max(size, len(text)), words + n
                out.append((last, "delta", delta, None))
            if isinstance(finish, str):
                closed = True
                out += [(last, "finish", "", finish), (last, DONE, "", None)]
        self.sent.update((size, words, last, closed))
        if self.idle_ms is not None:  # without, there are no timers to ask for
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not closed:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        size, words, last, closed = self.sent.get() if self.sent.exists() else (0, 0, -1, True)
        self.sent.update((size, words, last, True))
        yield from self._rows(key, [] if closed else [(last, DONE, "", "idle")])


def deltas(stream: DataFrame, key: str, seq: str, text: str, finish: Column | None = None, budget: int | None = None, idle_ms: int | None = None) -> DataFrame:
    """(key, seq, kind, delta, finish_reason) of a stream of growing texts.

    A ``delta`` row holds what a text adds to those before it, a ``finish`` row the reason that came with
    a text, and a ``[DONE]`` row closes the key: after a reason, when a delta would take the words of
    the key beyond ``budget`` (that delta is not sent), or when nothing came for ``idle_ms``.  What comes for a closed
    key is dropped.  Rows of a key come in the order of ``seq``; a null text adds nothing.
    """
    use_state_store(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), F.col(text).alias("text"), (F.lit(None).cast("string") if finish is None else finish).alias("finish"))
    names = (key, seq, "kind", "delta", "finish_reason")
    schema = f"`{key}` {kind}, `{seq}` bigint, kind string, delta string, finish_reason string"
    return rows.groupBy("key").transformWithStateInPandas(_Deltas(names, budget, idle_ms), schema, "Append", "None" if idle_ms is None else "ProcessingTime")


def drained(stream: DataFrame, path: str) -> DataFrame:
    """What a stream gives until its source has no more, as a table below ``path``."""
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


# ---- near deduplication ------------------------------------------------------------------------


def planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    """Normals of random hyperplanes: (tables, bits, dim)."""
    return np.random.default_rng(seed).normal(size=(tables, bits, dim))


def buckets(vector: Column, normals: np.ndarray, flips: int) -> Column:
    """Bucket numbers of a vector: the sides it is on, in each table; with ``flips`` also the buckets
    beyond one plane each, of those nearest to it."""

    @F.pandas_udf("array<bigint>")
    def place(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        side = np.einsum("tbd,nd->ntb", normals, np.stack(v.to_numpy()))
        code = (side > 0) @ (1 << np.arange(normals.shape[1], dtype=np.int64))
        nearest = np.argsort(np.abs(side), axis=2)[:, :, :flips]
        every = np.concatenate([code[:, :, None], code[:, :, None] ^ (np.int64(1) << nearest)], 2)
        every = every + (np.arange(normals.shape[0], dtype=np.int64) << 40)[None, :, None]
        return pd.Series(list(every.reshape(len(v), -1)))

    return place(vector)


class _Near(StatefulProcessor):
    """Per bucket: the vectors of stored rows. Says of each asked row whether one is within reach."""

    def __init__(self, threshold: float, ttl_ms: int | None):
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle) -> None:
        self.held = handle.getListState("held", "v array<double>", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        every = pd.concat(list(rows))
        fresh = every[every["stored"]]
        if len(fresh):
            self.held.appendList([(list(v),) for v in fresh["v"]])
        asked = every[~every["stored"]]
        if len(asked):
            known = [x[0] for x in self.held.get()] if self.held.exists() else []
            near = np.zeros(len(asked), bool)
            if known:
                a, b = np.stack(asked["v"].to_numpy()), np.array(known)
                d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
                near = d.min(1) <= self.threshold + 1e-12
            yield pd.DataFrame({"row": asked["row"].to_numpy(), "near": near})


def append_unless_near(stream: DataFrame, path: str, checkpoint: str, threshold: float, key: str, vector: str, dim: int, tables: int = 6, bits: int = 10, flips: int = 4, ttl_ms: int | None = None, seed: int = 0):
    """Rows that are near neither a stored row nor an earlier row of their batch, to the table ``path``;
    the started query (end it when it has processed all that is available).

    The stored rows flow back as a second source: a row is put in one bucket of random hyperplanes in each of
    ``tables`` tables, as state, for ``ttl_ms`` or for good; a row that is asked about is compared with
    those in its own buckets and in those beyond the ``flips`` nearest planes.  So a batch does not read the history
    again.  A near row that shares none of these buckets is missed (tests measure how many);
    ``append.append_unless_similar`` is the exact way.  Inside a batch rows are compared exactly.
    Rows without a vector are stored, and compared with nothing. A batch done again replaces its rows.
    """
    spark = stream.sparkSession
    use_state_store(spark)
    schema = T.StructType([f for f in stream.schema.fields])
    # the source that flows back needs a folder to look at
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/batch=-1")
    normals = planes(dim, tables, bits, seed)
    back = spark.readStream.schema(schema).parquet(f"{path}/batch=*")
    v = lambda df: F.col(vector).cast("array<double>")
    put = back.where(F.col(vector).isNotNull()).select(F.explode(buckets(v(back), normals, 0)).alias("bucket"), v(back).alias("v"), F.lit(True).alias("stored"), F.lit(None).cast("string").alias("row"))
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), {"ignoreNullFields": "false"})
    plain = F.when(F.col(vector).isNotNull(), v(stream)).otherwise(F.array_repeat(F.lit(0.0), dim))
    ask = stream.select(F.explode(buckets(plain, normals, flips)).alias("bucket"), plain.alias("v"), F.lit(False).alias("stored"), row.alias("row"))
    said = put.unionByName(ask).groupBy("bucket").transformWithStateInPandas(_Near(threshold, ttl_ms), "row string, near boolean", "Append", "None" if ttl_ms is None else "ProcessingTime")

    def store(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():  # else only stored rows came back, and an empty file would too
                write(df, number)
        finally:
            df.unpersist()

    def write(df: DataFrame, number: int) -> None:
        once = df.groupBy("row").agg(F.max("near").alias("near")).where("not near").select(F.from_json("row", schema).alias("r")).select("r.*")
        bare = once.where(F.col(vector).isNull())
        kept = greedy_dedup(once.where(F.col(vector).isNotNull()), threshold, key, vector).unionAll(bare)
        kept.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return said.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).outputMode("append").start()
