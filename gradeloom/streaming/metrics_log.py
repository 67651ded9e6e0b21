"""Metrics logs as append-only tables that are read while they grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gradeloom.fixed import SUMMARY_METRICS
from gradeloom.operators.runs import logged_steps
from gradeloom.schemas import METRICS_LOG
from gradeloom.sources.jsonl import append_jsonl
from gradeloom.streaming.merge_log import MergeLog


def append_metrics(rows: DataFrame, path: str, ord_col: str = "ord") -> str:
    """Add rows to a metrics log.

    File names say nothing about the order rows were logged in, so each row has to
    bring its position.
    """
    if ord_col not in rows.columns:
        raise ValueError(f"a metrics row needs its log position in {ord_col!r}")
    return append_jsonl(rows, path)


def read_metrics(
    spark: SparkSession, path: str, schema: T.StructType | str = METRICS_LOG
) -> DataFrame:
    """The log so far. Rows of different events fill different columns."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def stream_metrics(
    spark: SparkSession, path: str, schema: T.StructType | str = METRICS_LOG
) -> DataFrame:
    """The log as a stream that follows new rows."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)


_AT = "__at"


def _latest_partial(metrics: Sequence[str], run: str, ord_col: str):
    """Last value of each metric and where it was logged, per run."""

    def reduce(log: DataFrame) -> DataFrame:
        rows = logged_steps(log)
        columns = []
        for name in metrics:
            value = F.col(name).cast("double") if name in rows.columns else F.lit(None).cast("double")
            at = F.when(value.isNotNull(), F.col(ord_col))
            columns += [F.max_by(value, at).alias(name), F.max(at).alias(f"{name}{_AT}")]
        return rows.groupBy(run).agg(*columns)

    return reduce


def _latest_merge(run: str):
    def merge(states: DataFrame) -> DataFrame:
        columns = []
        for name in [c for c in states.columns if f"{c}{_AT}" in states.columns]:
            columns += [F.max_by(name, f"{name}{_AT}").alias(name), F.max(f"{name}{_AT}").alias(f"{name}{_AT}")]
        return states.groupBy(run).agg(*columns)

    return merge


def follow_latest(
    log: DataFrame,
    target: str,
    checkpoint: str,
    metrics: Sequence[str] = SUMMARY_METRICS,
    run: str = "run",
    ord_col: str = "ord",
    once: bool = False,
    every: int = 10,
) -> StreamingQuery:
    """Keep a table of each run's latest metrics up to date while the log grows.

    A batch writes one row for each run it has rows of, so its cost follows what has changed; a
    base of all runs is written every ``every`` batches.
    """
    state = MergeLog(target, _latest_partial(metrics, run, ord_col), _latest_merge(run), every)
    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(state.add)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_latest(spark: SparkSession, target: str, run: str = "run") -> DataFrame:
    """The latest metrics of each run, of all complete batches."""
    state = MergeLog(target, lambda rows: rows, _latest_merge(run)).read(spark)
    return state.select(*[c for c in state.columns if not c.endswith(_AT)])
