"""Fixed record types. Every normaliser ends in one of these."""

from __future__ import annotations

from pyspark.sql import types as T

METADATA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("raw_keys", T.ArrayType(T.StringType())),
    ]
)

UNIFIED = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

REWARD = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("score_chosen", T.DoubleType()),
        T.StructField("score_rejected", T.DoubleType()),
        T.StructField("metadata", METADATA),
    ]
)

RL_PROMPT = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

EVAL_ROW = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("reference", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("predicted_answer", T.StringType()),
    ]
)

METRICS_LOG = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("mean_reward", T.DoubleType()),
        T.StructField("mean_correctness_reward", T.DoubleType()),
        T.StructField("mean_rlaif_reward", T.DoubleType()),
        T.StructField("mean_format_reward", T.DoubleType()),
        T.StructField("tokens_per_sec", T.DoubleType()),
        T.StructField("samples_per_sec", T.DoubleType()),
        T.StructField("peak_memory_gb", T.DoubleType()),
        T.StructField("elapsed_sec", T.DoubleType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("file_name", T.StringType()),
        T.StructField("formatting", T.StringType()),
        T.StructField("ranking", T.BooleanType()),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
    ]
)


def with_ordinal_field(schema: T.StructType, name: str = "ord") -> T.StructType:
    """The record type with the input ordinal that order-sensitive steps need."""
    return T.StructType([*schema.fields, T.StructField(name, T.LongType())])
