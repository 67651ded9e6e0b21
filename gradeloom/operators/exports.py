"""Training tables in the layouts that trainers read, and their column maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.fixed import TRAINING_SYSTEM_PROMPT
from gradeloom.functions.prompts import chat_messages

# How each exported layout names its logical columns.
CHAT_LAYOUT = {"formatting": "sharegpt", "ranking": None, "columns": {"messages": "messages"}}
PREFERENCE_LAYOUT = {
    "formatting": "alpaca",
    "ranking": True,
    "columns": {"prompt": "prompt", "chosen": "chosen", "rejected": "rejected"},
}
INSTRUCTION_LAYOUT = {
    "formatting": "alpaca",
    "ranking": None,
    "columns": {"prompt": "instruction", "query": "input", "response": "output"},
}


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def _metadata(df: DataFrame) -> Column:
    if "metadata" in df.columns:
        return F.col("metadata")
    return F.create_map().cast("map<string,string>").alias("metadata")


def _order(df: DataFrame, order: str | None) -> list[Column]:
    return [F.col(order)] if order else []


def _required(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def chat_table(df: DataFrame, system_prompt: str = TRAINING_SYSTEM_PROMPT, order: str | None = None) -> DataFrame:
    """Unified records as ``messages, answer, metadata``; ``order`` goes along for an ordered sink."""
    _required(df, "prompt")
    return df.select(
        chat_messages("prompt", _text(df, "response"), system_prompt).alias("messages"),
        _text(df, "answer").alias("answer"),
        _metadata(df),
        *_order(df, order),
    )


def preference_table(df: DataFrame, order: str | None = None) -> DataFrame:
    """Pairs as ``prompt, chosen, rejected, answer, metadata``, without their scores."""
    _required(df, "prompt", "chosen", "rejected")
    # Ranked pairs have a source only; an object without a key is not one with a null.
    tags = F.parse_json(F.to_json(_metadata(df))).alias("metadata")
    return df.select("prompt", "chosen", "rejected", _text(df, "answer").alias("answer"), tags, *_order(df, order))


def instruction_table(df: DataFrame, order: str | None = None) -> DataFrame:
    """Prompt records as ``instruction, input, output, answer, metadata``."""
    _required(df, "prompt")
    return df.select(
        F.col("prompt").alias("instruction"),
        F.lit("").alias("input"),
        F.lit("").alias("output"),
        _text(df, "answer").alias("answer"),
        _metadata(df),
        *_order(df, order),
    )
