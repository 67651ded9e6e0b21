"""Preference pairs that stay current while scores arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gradeloom.operators.pairs import merged_ends, pairs_of_ends, response_ends
from gradeloom.streaming.merge_log import MergeLog


def ends_log(target: str, ord_col: str = "ord", every: int = 10) -> MergeLog:
    """Both ends of each prompt's responses below ``target``."""
    return MergeLog(target, lambda rows: response_ends(rows, ord_col), merged_ends, every)


def follow_pairs(
    records: DataFrame, target: str, checkpoint: str, ord_col: str = "ord", every: int = 10, once: bool = False
) -> StreamingQuery:
    """Keep both ends of every prompt up to date while scored records arrive.

    A batch writes the prompts it has records of and nothing else; what is kept per prompt is of
    fixed size however many responses it has had.
    """
    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(ends_log(target, ord_col, every).add)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_pairs(spark: SparkSession, target: str) -> DataFrame:
    """The pairs of all records so far, as :func:`pairs_from_scores` would give them."""
    return pairs_of_ends(ends_log(target).read(spark))
