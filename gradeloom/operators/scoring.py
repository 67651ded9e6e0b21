"""Scoring of completion tables and the hooks for the user's own models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.answers import extract_final_answer, with_answer_match
from gradeloom.functions.prompts import completion_text
from gradeloom.functions.rewards import RewardWeights, combined_reward, format_reward
from gradeloom.fixed import MATCH_TOLERANCE

# Prepared column names of the reward parts.
PARTS = ("correctness_reward", "rlaif_reward", "format_reward", "combined_reward")


class Scorer(Protocol):
    """A model that scores one response."""

    def score(self, prompt: str, response: str) -> float: ...


class BatchScorer(Protocol):
    """A model that scores many responses at once."""

    def score_batch(self, prompts: list[str], responses: list[str]) -> list[float]: ...


class ChatTemplate(Protocol):
    """Anything that renders a list of ``{role, content}`` to text when told not to tokenise."""

    def apply_chat_template(
        self, messages: list[dict[str, str]], tokenize: bool, add_generation_prompt: bool
    ) -> str: ...


def scorer_udf(factory: Callable[[], Scorer | BatchScorer]) -> Callable[..., Column]:
    """Vectorised function ``(prompt, response) -> double`` around a user's model.

    ``factory`` runs once per task, on the executor, so the model is loaded there
    and never sent over. A ``score_batch`` method gets whole Arrow batches. Marked as
    not repeatable, which keeps later filters from calling the model twice per row.
    """

    @F.pandas_udf("double")
    def model_score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for prompts, responses in batches:
            if hasattr(model, "score_batch"):
                values = model.score_batch(prompts.tolist(), responses.tolist())
            else:
                values = [model.score(p, r) for p, r in zip(prompts, responses)]
            if len(values) != len(prompts):
                raise ValueError("the scorer must return one value per response")
            yield pd.Series(values, dtype="float64")

    return model_score.asNondeterministic()


def chat_template_udf(factory: Callable[[], ChatTemplate]) -> Callable[..., Column]:
    """Vectorised function ``messages -> text`` around a user's chat template."""

    @F.pandas_udf("string")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        template = factory()
        for messages in batches:
            yield messages.map(
                lambda turns: template.apply_chat_template(
                    [{"role": t["role"], "content": t["content"]} for t in turns],
                    tokenize=False,
                    add_generation_prompt=False,
                )
            )

    return render.asNondeterministic()


def generate_completions(
    df: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    prompt: str = "prompt",
    output: str = "prediction",
) -> DataFrame:
    """Add the completion a user's model gives for each prompt.

    ``factory`` runs once per task and returns a function from a list of prompts to
    a list of completions. Only the prompts are handed to Python.
    """

    @F.pandas_udf("string")
    def complete(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generate = factory()
        for texts in batches:
            completions = generate(texts.tolist())
            if len(completions) != len(texts):
                raise ValueError("the model must return one completion per prompt")
            yield pd.Series(completions, dtype="object")

    return df.withColumn(output, complete.asNondeterministic()(prompt))


def score_completions(
    df: DataFrame,
    prompt: str = "prompt",
    response: str = "response",
    answer: str | None = "answer",
    weights: RewardWeights = RewardWeights(),
    sections: Sequence[str] | None = None,
    scorer: Callable[[], Scorer | BatchScorer] | None = None,
    tolerance: float = MATCH_TOLERANCE,
) -> DataFrame:
    """Add the extracted answer and the four reward columns to a completions table.

    Prompt and response may be text, one chat message or a list of them. An empty
    or missing answer scores 0.0 for correctness, and without a scorer the model
    part is 0.0; weights are not rescaled. One narrow stage, without Python unless a
    scorer is given.
    """
    gold = F.coalesce(F.col(answer), F.lit("")) if answer else F.lit("")
    texts = {
        "__prompt": F.coalesce(completion_text(prompt, df.schema[prompt].dataType), F.lit("")),
        "__response": (
            F.coalesce(F.col(response), F.lit(""))
            if isinstance(df.schema[response].dataType, T.StringType)
            else completion_text(response, df.schema[response].dataType)
        ),
        "__gold": gold,
    }
    staged = df.withColumns(texts).withColumns(
        {
            "predicted_answer": extract_final_answer("__response"),
            "format_reward": format_reward("__response", sections),
        }
    )
    matched = with_answer_match(staged, "predicted_answer", "__gold", "__match", tolerance)
    if scorer is None:
        model_part = F.lit(0.0)
    else:
        model_part = scorer_udf(scorer)("__prompt", "__response")
    scored = matched.withColumns(
        {
            "correctness_reward": F.when(
                (F.col("__gold") != "") & F.col("__match"), F.lit(1.0)
            ).otherwise(F.lit(0.0)),
            "rlaif_reward": model_part,
        }
    )
    total = combined_reward("correctness_reward", "rlaif_reward", "format_reward", weights)
    added = ("predicted_answer", *PARTS)
    kept = [name for name in df.columns if name not in added]
    return scored.withColumn("combined_reward", total).select(*kept, *added)


def reward_values(df: DataFrame, output: str = "reward", **options) -> DataFrame:
    """The input with one combined reward per completion, as trainers want it."""
    scored = score_completions(df, **options)
    return scored.select(*df.columns, F.col("combined_reward").alias(output))
