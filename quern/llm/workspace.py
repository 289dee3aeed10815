"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A table written here cuts lineage like ``checkpoint()``: every executor can read it again after
another one is lost.  Where the setting is absent, a temporary folder is used if all of Spark runs in
one process (tests, a laptop); on a cluster it is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="quern-")
        base = "file://" + _own[app]
    return f"{base.rstrip('/')}/quern/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` has written, when nothing that is still to be computed reads them."""
    for t in tables:
        path = getattr(t, "_quern_path", None)
        if path:
            remove(t.sparkSession, path)


def small_batches(spark: SparkSession, rows: int = 2000, size: int = 8_000_000) -> None:
    """Bound the batches that Python workers get, unless the session bounds them more tightly."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = str(spark.conf.get(name)).lower()
        if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            spark.conf.set(name, str(most))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one (any store that Hadoop reaches)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete every intermediate table of this application (call it when results are stored)."""
    remove(spark, shared_dir(spark))


def fresh(names, *wanted: str) -> list[str]:
    """Working column names that clash with none of ``names`` (compared without case)."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w = "_" + w
        taken.add(w.lower())
        out.append(w)
    return out
