"""Reward parts and simple rates as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.fixed import (
    CORRECTNESS_WEIGHT,
    FORMAT_WEIGHT,
    MODEL_WEIGHT,
    REQUIRED_SECTIONS,
    SCORER_PROMPT_LABEL,
    SCORER_RESPONSE_LABEL,
)
from gradeloom.functions.whitespace import ColumnOrName, as_column


@dataclass(frozen=True)
class RewardWeights:
    """Share of each part in the combined reward. They need not add up to one."""

    correctness: float = CORRECTNESS_WEIGHT
    rlaif: float = MODEL_WEIGHT
    format: float = FORMAT_WEIGHT


def sections_or_default(sections: Sequence[str] | None) -> list[str]:
    """The given section names, or the standard three when none are given."""
    return list(sections or REQUIRED_SECTIONS)


def section_flags(text: ColumnOrName, sections: Sequence[str]) -> Column:
    """Map from section name to whether the text mentions it."""
    body = F.coalesce(as_column(text), F.lit(""))
    names = list(dict.fromkeys(sections))
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]),
        F.array(*[F.contains(body, F.lit(name)) for name in names]),
    )


def format_reward(text: ColumnOrName, sections: Sequence[str] | None = None) -> Column:
    """Share of the sections present. A repeated name weighs in the total only."""
    wanted = sections_or_default(sections)
    body = F.coalesce(as_column(text), F.lit(""))
    present = F.lit(0.0)
    for name in dict.fromkeys(wanted):
        present = present + F.contains(body, F.lit(name)).cast("double")
    return present / F.lit(float(len(wanted)))


def passes_threshold(score: ColumnOrName, threshold: float = 1.0) -> Column:
    """True when a format score reaches the threshold."""
    return as_column(score) >= F.lit(float(threshold))


def combined_reward(
    correctness: ColumnOrName,
    rlaif: ColumnOrName,
    structure: ColumnOrName,
    weights: RewardWeights = RewardWeights(),
) -> Column:
    """Weighted sum of the three parts, added in this order."""
    return (
        F.lit(float(weights.correctness)) * as_column(correctness)
        + F.lit(float(weights.rlaif)) * as_column(rlaif)
        + F.lit(float(weights.format)) * as_column(structure)
    )


def scorer_text(prompt: ColumnOrName, response: ColumnOrName) -> Column:
    """Text a scoring model reads for one prompt and response."""
    return F.concat(
        F.lit(SCORER_PROMPT_LABEL),
        as_column(prompt),
        F.lit(SCORER_RESPONSE_LABEL),
        as_column(response),
    )


def safe_rate(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient, or 0.0 when the denominator is not positive."""
    below = as_column(denominator)
    return F.when(below > 0, as_column(numerator) / below).otherwise(F.lit(0.0))
