"""Schemas of the engine's tables."""

from pyspark.sql import types as T

INSTRUCTION = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("system", T.StringType()),
        T.StructField("skip_prompt_formatting", T.BooleanType()),
    ]
)
#: Working columns that never reach a sink.
TRANSIENT = ("skip_counting", "characterized")
CARD = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "description", "stay_in_character")])
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
CONVERSATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("conversations", T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))),
    ]
)
ROUTING = T.StructType([T.StructField("expert", T.StringType()), T.StructField("instruction", T.StringType())])
EMBEDDED = T.StructType([T.StructField("id", T.LongType()), T.StructField("category", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
