"""Best/worst pairs from scored responses."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.fixed import DEFAULT_PAIR_SOURCE
from gradeloom.operators.normalize import normalize_rewards
from gradeloom.operators.ordered import with_rank

Mode = Literal["auto", "pairs", "scored", "per_row"]


def response_ends(records: DataFrame, ord_col: str = "ord") -> DataFrame:
    """What pairs follow from: ``prompt, responses, best, worst, first_ord`` per prompt.

    The best response is the first of the highest score and the worst the last of
    the lowest. Both are the ends of one ordering, so a prompt is reduced by plain
    min and max: partial results are combined before the shuffle and a prompt with
    very many responses costs no task more than its partial results.
    """
    scored = F.col("score_chosen").isNotNull()
    end = F.struct(
        (-F.col("score_chosen")).alias("down"),
        F.col(ord_col).alias("at"),
        F.col("chosen").alias("text"),
        F.coalesce(F.col("answer"), F.lit("")).alias("answer"),
        F.col("metadata.source").alias("source"),
    )
    return records.groupBy("prompt").agg(
        F.count("score_chosen").alias("responses"),
        F.min(F.when(scored, end)).alias("best"),
        F.max(F.when(scored, end)).alias("worst"),
        F.min(ord_col).alias("first_ord"),
    )


def merged_ends(ends: DataFrame) -> DataFrame:
    """Ends of several disjoint sets of records as those of all of them."""
    return ends.groupBy("prompt").agg(
        F.sum("responses").alias("responses"),
        F.min("best").alias("best"),
        F.max("worst").alias("worst"),
        F.min("first_ord").alias("first_ord"),
    )


def pairs_of_ends(ends: DataFrame) -> DataFrame:
    """One pair per prompt with at least two scored responses."""
    answer = F.when(F.col("best.answer") != "", F.col("best.answer")).otherwise(
        F.col("worst.answer")
    )
    return ends.where(F.col("responses") >= 2).select(
        "prompt",
        F.col("best.text").alias("chosen"),
        F.col("worst.text").alias("rejected"),
        answer.alias("answer"),
        (-F.col("best.down")).alias("score_chosen"),
        (-F.col("worst.down")).alias("score_rejected"),
        F.struct(
            F.coalesce(F.col("best.source"), F.lit(DEFAULT_PAIR_SOURCE)).alias("source"),
            F.lit(None).cast("array<string>").alias("raw_keys"),
        ).alias("metadata"),
        "first_ord",
    )


def pairs_from_scores(records: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One chosen/rejected pair per prompt with at least two scored responses.

    Rows come unordered; ``first_ord`` is the first position of the prompt in the input.
    """
    return pairs_of_ends(response_ends(records, ord_col))


def rank_responses(
    records: DataFrame, ord_col: str = "ord", output: str = "rank"
) -> DataFrame:
    """Scored responses with their rank in the prompt, best first, ties in input order."""
    scored = records.where(F.col("score_chosen").isNotNull())
    order = [-F.col("score_chosen"), F.col(ord_col)]
    return with_rank(scored, ["prompt"], order, output)


def complete_pairs(records: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Records that already have a rejected text, in the layout of the pairs."""
    return records.where(F.col("rejected") != "").withColumnRenamed(ord_col, "first_ord")


def has_open_records(records: DataFrame) -> bool:
    """True when any record lacks its rejected text. Stops at the first one found."""
    return not records.where(F.col("rejected") == "").select(F.lit(1)).isEmpty()


def resolve_pairs(records: DataFrame, mode: Mode = "auto", ord_col: str = "ord") -> DataFrame:
    """Reward records to finished pairs.

    ``auto`` looks at the whole table: a single record without a rejected text sends
    all of them through :func:`pairs_from_scores`, otherwise all are kept as they
    are. ``pairs`` and ``scored`` name the branch and save the look. ``per_row``
    keeps finished pairs and ranks only the open records.
    """
    if mode == "per_row":
        open_records = records.where(F.col("rejected") == "")
        return complete_pairs(records, ord_col).unionByName(pairs_from_scores(open_records, ord_col))
    if mode == "auto":
        mode = "scored" if has_open_records(records) else "pairs"
    return pairs_from_scores(records, ord_col) if mode == "scored" else complete_pairs(records, ord_col)


def convert_rewards(
    df: DataFrame,
    source_name: str,
    limit: int | None = None,
    mode: Mode = "auto",
    ord_col: str = "ord",
) -> DataFrame:
    """Raw preference table to finished pairs."""
    return resolve_pairs(normalize_rewards(df, source_name, limit, ord_col), mode, ord_col)
