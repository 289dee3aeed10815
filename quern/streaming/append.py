"""Streams of instruction rows: append, exact and near deduplication, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.similarity import drop_similar, greedy_dedup
from ..sources.jsonl import cleaned


def read_stream(spark: SparkSession, path: str, schema=schemas.INSTRUCTION, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def exact_once(stream: DataFrame, columns: list[str], time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Each key once; with an event time, state is bounded by the watermark."""
    if time is None:
        return stream.dropDuplicates(columns)
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(columns)


def append(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Cleaned rows to JSON files; the checkpoint is where a restart goes on."""
    writer = cleaned(stream).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_unless_similar(stream: DataFrame, history: str, checkpoint: str, threshold: float, key: str, vector: str, available_now: bool = True):
    """Rows that are near neither a stored row nor an earlier row of their batch, to a Parquet table.

    A batch is written to a folder of its own number, so a batch that runs again replaces its rows.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        parts = [p for p in _parts(spark, history) if int(p.rpartition("=")[2]) < number]
        fresh = df
        if parts:
            fresh = drop_similar(df, spark.read.parquet(*parts), threshold, key, vector, key)
        greedy_dedup(fresh, threshold, key, vector).write.mode("overwrite").parquet(f"{history}/batch={number}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _parts(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    return [s.getPath().toString() for s in fs.listStatus(at) if "batch=" in s.getPath().getName()]


def counts(stream: DataFrame, category: str = "category") -> DataFrame:
    return stream.groupBy(category).agg(F.count(F.lit(1)).alias("count"))


def windowed_counts(stream: DataFrame, time: str, width: str, by: str, delay: str = "1 hour") -> DataFrame:
    """Rows and sums in tumbling windows of event time; late rows beyond ``delay`` are left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n"))
