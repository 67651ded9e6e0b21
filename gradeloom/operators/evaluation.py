"""Evaluation rows and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.fixed import MATCH_TOLERANCE
from gradeloom.functions.answers import extract_final_answer, with_answer_match
from gradeloom.functions.rewards import format_reward, passes_threshold


def join_by_key(left: DataFrame, right: DataFrame, *key: str) -> DataFrame:
    """Rows of both tables that belong together, by key instead of by position.

    An inner join: what has no partner is left out. No side is forced to be
    broadcast; Spark does that by itself when it has measured a side to be small.
    """
    return left.join(right, list(key), "inner")


def eval_rows(
    df: DataFrame,
    question: str = "question",
    reference: str = "answer",
    prediction: str = "prediction",
    keep: Sequence[str] = (),
    gold_pattern: str | None = None,
) -> DataFrame:
    """Project to ``question, reference, prediction, predicted_answer``.

    Column names are configurable and a missing column reads as empty text. The
    reference is used as it is unless ``gold_pattern`` (one group) cuts the answer
    out of it.
    """

    def text(name: str):
        return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")

    gold = text(reference)
    if gold_pattern is not None:
        found = F.regexp_extract(gold, gold_pattern, 1)
        gold = F.when(found != "", found).otherwise(gold)
    return df.select(
        *keep,
        text(question).alias("question"),
        gold.alias("reference"),
        text(prediction).alias("prediction"),
    ).withColumn("predicted_answer", extract_final_answer("prediction"))


def with_exact_match(df: DataFrame, tolerance: float = MATCH_TOLERANCE) -> DataFrame:
    """Add ``exact_match`` (1.0 or 0.0) to evaluation rows."""
    matched = with_answer_match(df, "predicted_answer", "reference", "__match", tolerance)
    return matched.withColumn("exact_match", F.col("__match").cast("double")).drop("__match")


def eval_summary(
    rows: DataFrame,
    by: Sequence[str] = ("dataset", "split"),
    sections: Sequence[str] | None = None,
    threshold: float = 1.0,
) -> DataFrame:
    """Samples, final-answer accuracy and format pass rate per group.

    ``rows`` are evaluation rows with the grouping columns. One aggregate; without
    grouping columns an empty input gives 0 samples and rates of 0.0.
    """
    scored = with_exact_match(rows).withColumn(
        "__passes", passes_threshold(format_reward("prediction", sections), threshold).cast("double")
    )
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.coalesce(F.avg("exact_match"), F.lit(0.0)).alias("final_answer_accuracy"),
        F.coalesce(F.avg("__passes"), F.lit(0.0)).alias("format_pass_rate"),
    )


def final_answer_accuracy(rows: DataFrame) -> DataFrame:
    """One row with the mean exact match; 0.0 for no rows."""
    return eval_summary(rows, by=()).select("final_answer_accuracy")


def format_pass_rate(
    rows: DataFrame, sections: Sequence[str] | None = None, threshold: float = 1.0
) -> DataFrame:
    """One row with the share of predictions that reach the format threshold."""
    passes = passes_threshold(format_reward("prediction", sections), threshold).cast("double")
    return rows.agg(F.coalesce(F.avg(passes), F.lit(0.0)).alias("format_pass_rate"))
