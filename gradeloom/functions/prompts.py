"""Prompt, chat and response texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import fixed
from gradeloom.functions.answers import extract_source_answer
from gradeloom.functions.numbers import float_text
from gradeloom.functions.whitespace import (
    ColumnOrName,
    as_column,
    clean_lines,
    let,
    strip,
)


def rl_prompt(question: ColumnOrName) -> Column:
    """Prompt-only text for reinforcement learning."""
    return F.concat(F.lit(fixed.RL_PROMPT_LEAD), strip(question))


def user_prompt(question: ColumnOrName) -> Column:
    """User turn put to the tutor."""
    return F.concat(F.lit(fixed.USER_PROMPT_LEAD), strip(question))


def tutor_generation_prompt(question: ColumnOrName) -> Column:
    """System prompt and user turn as one plain text for a local model."""
    return F.concat(F.lit(fixed.TUTOR_SYSTEM_PROMPT + "\n\n"), user_prompt(question))


def _tutor_sections(lines: Column, answer: Column) -> Column:
    steps = F.when(F.size(lines) > 0, F.array_join(lines, "\n"))
    return F.concat(
        F.lit(fixed.TUTOR_OVERVIEW + fixed.TUTOR_THOUGHT_HEADING),
        F.coalesce(F.get(lines, 0), F.lit(fixed.DEFAULT_THOUGHT)),
        F.lit("\n\n" + fixed.TUTOR_STEPS_HEADING),
        F.coalesce(steps, F.lit(fixed.DEFAULT_STEPS)),
        F.lit("\n\n" + fixed.TUTOR_ANSWER_HEADING),
        answer,
        F.lit("\n\n" + fixed.TUTOR_SUMMARY),
    )


def _shown_answer(answer: Column, extracted: Column) -> Column:
    return F.when(F.coalesce(answer, F.lit("")) != "", answer).otherwise(
        F.coalesce(F.nullif(extracted, F.lit("")), F.lit(fixed.PENDING_ANSWER))
    )


def tutor_response(solution: ColumnOrName, answer: ColumnOrName) -> Column:
    """Five-section tutor response built from a worked solution and its answer."""
    text = F.coalesce(as_column(solution), F.lit(""))
    shown = _shown_answer(as_column(answer), extract_source_answer(text))
    return let(
        F.struct(clean_lines(text).alias("lines"), shown.alias("shown")),
        lambda parts: _tutor_sections(parts["lines"], parts["shown"]),
    )


def with_tutor_response(
    df: DataFrame, solution: ColumnOrName, answer: ColumnOrName, output: str
) -> DataFrame:
    """Add :func:`tutor_response` in narrow steps that stay in generated code."""
    lines, shown = "__tutor_lines", "__tutor_shown"
    text = F.coalesce(as_column(solution), F.lit(""))
    return (
        df.withColumns(
            {
                lines: clean_lines(text),
                shown: _shown_answer(as_column(answer), extract_source_answer(text)),
            }
        )
        .withColumn(output, _tutor_sections(F.col(lines), F.col(shown)))
        .drop(lines, shown)
    )


def chat_messages(
    prompt: ColumnOrName,
    response: ColumnOrName,
    system_prompt: str = fixed.TRAINING_SYSTEM_PROMPT,
) -> Column:
    """System, user and assistant turn as an array of ``role, content``."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        turn("system", F.lit(system_prompt)),
        turn("user", as_column(prompt)),
        turn("assistant", as_column(response)),
    )


def sft_text(
    prompt: ColumnOrName,
    response: ColumnOrName,
    system_prompt: str = fixed.TRAINING_SYSTEM_PROMPT,
) -> Column:
    """One training text in the plain role-tag template."""
    return F.concat(
        F.lit(f"<|system|>\n{system_prompt}\n<|user|>\n"),
        as_column(prompt),
        F.lit("\n<|assistant|>\n"),
        as_column(response),
    )


def _turn_text(role: Column, content: Column) -> Column:
    return F.concat(F.upper(role), F.lit(":\n"), content)


_ASSISTANT_CUE = "\n\nASSISTANT:\n"


def flatten_messages(messages: ColumnOrName) -> Column:
    """A message array as one prompt text that ends with the assistant's cue."""
    turns = F.transform(as_column(messages), lambda m: _turn_text(m["role"], F.coalesce(m["content"], F.lit(""))))
    return F.concat(F.array_join(turns, "\n\n"), F.lit(_ASSISTANT_CUE))


def flatten_turns(
    df: DataFrame, key: str, turn: str, role: str, text: str, output: str = "prompt"
) -> DataFrame:
    """Turn rows to one prompt text per conversation.

    Each conversation becomes a single string, so a group is never larger than the
    row it produces.
    """
    # A turn without text keeps its place.
    line = _turn_text(F.col(role), F.coalesce(F.col(text), F.lit("")))
    return (
        df.select(F.col(key), F.col(turn).alias("__turn"), line.alias("__line"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("__turn", "__line"))).alias("__turns"))
        .select(
            F.col(key),
            F.concat(
                F.array_join(F.col("__turns.__line"), "\n\n"), F.lit(_ASSISTANT_CUE)
            ).alias(output),
        )
    )


def completion_text(completion: ColumnOrName, data_type: T.DataType) -> Column:
    """Plain text of a completion column of type ``data_type``.

    Strings pass through, a struct or map gives its ``content``, an array gives its
    non-empty parts joined by a newline, and anything else its printed form.
    """
    value = as_column(completion)
    if isinstance(data_type, T.StringType):
        return F.coalesce(value, F.lit("None"))
    if isinstance(data_type, T.StructType):
        if "content" not in data_type.fieldNames():
            return F.lit("")
        return _printed(value["content"], data_type["content"].dataType)
    if isinstance(data_type, T.MapType):
        content = _printed(F.try_element_at(value, F.lit("content")), data_type.valueType)
        return F.when(F.map_contains_key(value, F.lit("content")), content).otherwise(F.lit(""))
    if isinstance(data_type, T.ArrayType):
        parts = F.transform(value, lambda part: completion_text(part, data_type.elementType))
        return F.array_join(F.filter(parts, lambda part: part != ""), "\n")
    return _printed(value, data_type)


def _printed(value: Column, data_type: T.DataType) -> Column:
    """A value as text: ``True``, ``1e+16``, ``None`` for null."""
    if isinstance(data_type, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False")).otherwise(F.lit("None"))
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.coalesce(float_text(value.cast("double")), F.lit("None"))
    return F.coalesce(value.cast("string"), F.lit("None"))
