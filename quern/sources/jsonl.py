"""JSONL, text and card tables: scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text as S

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_instructions(spark: SparkSession, paths, keep_corrupt: bool = False) -> DataFrame:
    """Instruction rows of JSONL files, plain or compressed, anywhere Spark reads.

    A row without a category is ``general``.  Lines that are no JSON object are left out, or kept
    with their text in ``_corrupt``.
    """
    lines = spark.read.text(paths).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.select(F.from_json("value", _with_corrupt(schemas.INSTRUCTION), options).alias("r")).select("r.*")
    rows = rows.withColumn("category", F.coalesce("category", F.lit("general")))
    return rows if keep_corrupt else rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_for_culling(spark: SparkSession, paths, numbered: bool = False) -> DataFrame:
    """Rows of several files beside their raw ``line``; one category goes by its newer name.

    ``numbered``: with ``rid``, the number of the line in the order of the files' names and of their lines.
    """
    from ..operators.sampling import numbered_in_ranges

    # inside a block of a file ids rise from line to line
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = spark.read.text(paths).select(F.col("value").alias("line"), place.alias("__o")).where(F.trim("line") != "")
    parsed = lines.withColumn("r", F.from_json("line", schemas.INSTRUCTION)).where(F.col("r").isNotNull())
    category = F.coalesce("r.category", F.lit("general"))
    rows = parsed.select(*[F.col(f"r.{f.name}") for f in schemas.INSTRUCTION if f.name != "category"], F.when(category == "reasoning_or_math", "orca").otherwise(category).alias("category"), "line", "__o")
    if not numbered:
        return rows.drop("__o")
    held, at, _ = numbered_in_ranges(rows.withColumn("__one", F.lit(0)), "__one", "__o")
    return held.withColumn("rid", at).select(*[c for c in rows.columns if c != "__o"], "rid")


def read_categorised(spark: SparkSession, paths) -> DataFrame:
    """Only rows that name a category."""
    rows = spark.read.schema(schemas.INSTRUCTION).json(paths)
    return rows.where(F.col("category").isNotNull() & (F.col("category") != ""))


def read_topics(spark: SparkSession, path, name: str = "topics") -> DataFrame:
    """(topic_idx, topic): distinct stripped lines, blank ones left out, numbered from 0 in their own
    order; none is an error."""
    from ..operators.sampling import numbered_in_ranges

    rows = spark.read.text(path).select(S.strip("value").alias("topic")).where("topic <> ''").distinct()
    if rows.isEmpty():
        raise ValueError(f"{name}: no topics in {path}")
    numbered, at, _ = numbered_in_ranges(rows.withColumn("__one", F.lit(0)), "__one", "topic")
    return numbered.select(at.alias("topic_idx"), "topic")


def read_template(spark: SparkSession, path: str | None, fallback: str) -> str:
    """A template's text: the given file's, else the packaged one."""
    if path is None:
        return fallback
    return spark.read.text(path, wholetext=True).first()["value"]


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Whole files, numbered by name: (seed_idx, seed)."""
    from ..operators.sampling import numbered_in_ranges

    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("__f"), F.col("value").alias("seed"), F.lit(0).alias("__one"))
    numbered, at, _ = numbered_in_ranges(files, "__one", "__f")
    return numbered.select(at.alias("seed_idx"), "seed")


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CARD).option("multiLine", True).json(path)


def read_routing(spark: SparkSession, path: str, most: int | None = None, seed: int = 0) -> DataFrame:
    """(expert, instruction) of files called ``expert_<name>.jsonl``; ``most`` rows of each, by a hash."""
    rows = spark.read.schema("instruction string").json(path).select(F.regexp_extract(F.input_file_name(), r"expert_([^/]*?)\.jsonl", 1).alias("expert"), "instruction").where("expert <> ''")
    if most is None:
        return rows
    from ..operators.sampling import take_per_group

    return take_per_group(rows, ["expert"], F.lit(most), "instruction", seed)


def cleaned(df: DataFrame) -> DataFrame:
    """Rows as they are stored: texts stripped, working columns gone."""
    out = df.drop(*schemas.TRANSIENT)
    for c in ("instruction", "response", "system"):
        if c in out.columns:
            out = out.withColumn(c, S.strip(c))
    return out


def append_instructions(df: DataFrame, path: str) -> None:
    cleaned(df).write.mode("append").json(path)


def write_instructions(df: DataFrame, path: str, overwrite: bool = False, append: bool = False) -> None:
    """Overwrite, append, or an error where there is output already."""
    cleaned(df).write.mode("overwrite" if overwrite else "append" if append else "errorifexists").json(path)


def write_topics(df: DataFrame, path: str) -> None:
    df.select(S.strip("topic").alias("value")).write.mode("append").text(path)


def write_cards(df: DataFrame, path: str) -> None:
    """A folder for each card, by the MD5 of its description; of equal names the first one by ``rid``
    is kept, where there is one, then by description."""
    first = [c for c in ("rid",) if c in df.columns]
    least = F.min_by(F.struct("description", "stay_in_character"), F.struct(*first, "description", "stay_in_character"))
    cards = df.groupBy("name").agg(least.alias("x")).select("name", "x.*").withColumn("card", F.md5("description"))
    cards.write.mode("append").partitionBy("card").json(path)


def write_expert_split(split: DataFrame, routing: DataFrame, path: str) -> None:
    split.write.mode("overwrite").partitionBy("expert").json(f"{path}/training_data")
    routing.write.mode("overwrite").partitionBy("expert").json(f"{path}/routing_data")


def write_conversations(df: DataFrame, path: str) -> None:
    df.select(F.uuid().alias("id"), "conversations").write.mode("overwrite").json(path)
