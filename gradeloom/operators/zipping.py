"""Tables that belong together by position instead of by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.evaluation import eval_rows, eval_summary
from gradeloom.operators.ordered import with_ordinal
from gradeloom.operators.scoring import score_completions

POSITION = "position"


class Zipped:
    """Several tables aligned by the position of their rows, cut to the shortest.

    ``tables`` names each output column and says where it comes from: a table, its value column
    and the unique order of its rows. Every table is numbered in its own order by ranges of it,
    over all tasks, with all its columns, and the rows of equal number are joined: an equality that spreads evenly,
    as every number occurs once. What the longer tables have beyond the shortest has
    no partner and is left out; :meth:`unpaired` has these rows and :meth:`report` counts them.
    """

    def __init__(self, tables: Mapping[str, tuple[DataFrame, str, Sequence[str | Column]]]) -> None:
        if len(tables) < 2:
            raise ValueError("pairing needs at least two tables")
        if POSITION in tables:
            raise ValueError(f"{POSITION!r} is the name of the position")
        self.parts: dict[str, DataFrame] = {}
        for name, (df, value, order) in tables.items():
            numbered = with_ordinal(df, order, "__position")
            self.parts[name] = numbered.select(F.col("__position").alias(POSITION), F.col(value).alias(name))

    def rows(self) -> DataFrame:
        """``position`` (from 0) and one column per table."""
        return reduce(lambda left, right: left.join(right, POSITION), self.parts.values())

    def report(self) -> DataFrame:
        """One row per table: ``table, rows, paired, unpaired``."""
        counts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in self.parts.items()]
        each = reduce(DataFrame.unionByName, counts)
        # One row per table.
        listed = each.agg(F.min("rows").alias("paired"), F.collect_list(F.struct("table", "rows")).alias("each"))
        placed = listed.select("paired", F.inline("each"))
        return placed.select("table", "rows", "paired", (F.col("rows") - F.col("paired")).alias("unpaired"))

    def unpaired(self, name: str) -> DataFrame:
        """Rows of a table beyond the shortest one."""
        return self.parts[name].join(self.rows().select(POSITION), POSITION, "left_anti")


Part = tuple[DataFrame, str, Sequence[str | Column]]


def score_zipped(prompts: Part, responses: Part, answers: Part, **options) -> DataFrame:
    """Rewards of responses that meet their prompts and answers by position.

    Options as for :func:`score_completions`.
    """
    zipped = Zipped({"prompt": prompts, "response": responses, "answer": answers})
    return score_completions(zipped.rows(), **options)


def accuracy_zipped(predictions: Part, references: Part) -> DataFrame:
    """One row: the pairs and the share of predictions that match the reference of their position.

    0 pairs and 0.0 without pairs.
    """
    rows = Zipped({"prediction": predictions, "answer": references}).rows()
    return eval_summary(eval_rows(rows), by=()).select("samples", "final_answer_accuracy")
