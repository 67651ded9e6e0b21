"""The harder part of a prompt table: strata by difficulty, exact quotas, choice by hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.selection import first_of_groups
from gradeloom.runtime import stored

# Upper bounds of the strata of difficulty, and how the sample is shared among them: the
# hardest stratum counts most.
HARDNESS_EDGES = (0.25, 0.5, 0.75)
HARDNESS_WEIGHTS = (1, 2, 3, 4)


def prompt_difficulty(scored: DataFrame, prompt: str = "prompt", correctness: str = "correctness_reward") -> DataFrame:
    """One row per prompt: ``prompt, completions, difficulty``.

    The difficulty is one minus the mean correctness of the prompt's completions, from 0 for
    prompts that are always answered to 1 for prompts that never are. Without any scored
    completion it is null.
    """
    mean = F.avg(correctness)
    return scored.groupBy(prompt).agg(F.count(correctness).alias("completions"), (1 - mean).alias("difficulty"))


def stratum_of(difficulty: Column, edges: Sequence[float] = HARDNESS_EDGES) -> Column:
    """Number of the stratum, from 0 for the easiest; a difficulty on an edge belongs below it."""
    passed = [(difficulty > F.lit(edge)).cast("int") for edge in edges]
    return sum(passed[1:], passed[0]) if passed else F.when(difficulty.isNotNull(), 0)


def stable_number(key: Column, seed: str = "harder") -> Column:
    """A number of 60 bits that any engine with MD5 computes alike from a key and a seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shared_quotas(sizes: Sequence[int], weights: Sequence[float], total: int) -> list[int]:
    """``total`` shared by weight, none above its size; the excess goes to the others by weight.

    Whole numbers: what rounding leaves goes one by one to the last strata that have room.
    Sums to ``total``, or to all there are if that is less.
    """
    wanted, open_, fixed = min(total, sum(sizes)), set(range(len(sizes))), {}
    while True:
        rest, weight = wanted - sum(fixed.values()), sum(weights[i] for i in open_)
        full = [i for i in open_ if weight == 0 or rest * weights[i] >= sizes[i] * weight]
        if not full or not open_:
            break
        for i in full:
            fixed[i] = sizes[i] if weight else 0
            open_.discard(i)
    quotas = [fixed[i] if i in fixed else int(rest * weights[i] // weight) for i in range(len(sizes))]
    while sum(quotas) < wanted:
        for i in reversed(range(len(sizes))):
            if quotas[i] < sizes[i] and sum(quotas) < wanted:
                quotas[i] += 1
    return quotas


def harder_subset(
    prompts: DataFrame,
    size: int,
    edges: Sequence[float] = HARDNESS_EDGES,
    weights: Sequence[float] = HARDNESS_WEIGHTS,
    key: str = "prompt",
    seed: str = "harder",
) -> DataFrame:
    """``size`` prompts, the harder strata more than the easier ones; adds ``stratum``.

    ``prompts`` has one row per ``key`` with its ``difficulty``. Each stratum gives exactly its quota,
    see :func:`shared_quotas`, of the rows with the smallest stable numbers, so reruns agree and
    a larger ``size`` keeps what a smaller one chose as long as no stratum's quota shrinks. Equal
    numbers go by key. Rows without difficulty are never chosen. The driver sees one count per stratum.
    """
    if len(weights) != len(edges) + 1:
        raise ValueError("one weight per stratum is needed")
    if list(edges) != sorted(edges):
        raise ValueError("the edges of the strata must ascend")
    placed = prompts.where(F.col("difficulty").isNotNull()).withColumn("stratum", stratum_of(F.col("difficulty"), edges))
    kept = stored(placed, "harder-strata")
    counted = {row["stratum"]: row["count"] for row in kept.groupBy("stratum").count().collect()}
    sizes = [counted.get(i, 0) for i in range(len(weights))]
    quotas = list(enumerate(shared_quotas(sizes, weights, size)))
    # One row per stratum.
    table = prompts.sparkSession.createDataFrame(quotas, "stratum int, quota long")
    return first_of_groups(kept, "stratum", key, stable_number(F.col(key), seed), table, "quota")
