"""Cutting lineage in iterative plans, in the shared folder named by ``spark.checkpoint.dir``.

A table written there cuts lineage like ``checkpoint()``: every executor can read it again after another
one is lost.  Unlike a checkpoint it can be released as soon as nothing reads it any more.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """The application's folder; a temporary one only where none is configured and all of Spark runs
    in one process."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + _own.setdefault(app, tempfile.mkdtemp(prefix="quern-"))
    return f"{base.rstrip('/')}/quern-core/{app}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, and read again."""
    spark = df.sparkSession
    path = f"{shared(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_table = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Deletes tables of ``cut`` that nothing still to be computed reads; others are left alone."""
    for t in tables:
        path = getattr(t, "_quern_table", None)
        if path:
            target = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
