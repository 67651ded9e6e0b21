"""Arriving rows: normalise and score without state, append to a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gradeloom.operators.scoring import score_completions

Transform = Callable[[DataFrame], DataFrame]


def append_stream(
    arriving: DataFrame,
    transform: Transform,
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    once: bool = False,
) -> StreamingQuery:
    """Run a row-wise transform over a stream and append its output to files.

    ``transform`` is any of the normalisers or scorers without a row limit; none
    keeps state, so there is nothing to expire. ``once`` takes in what is there and
    stops.
    """
    writer = (
        transform(arriving)
        .writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start(target)


def score_stream(
    arriving: DataFrame, target: str, checkpoint: str, once: bool = False, **options
) -> StreamingQuery:
    """Score arriving completions; options as for :func:`score_completions`."""
    return append_stream(
        arriving, lambda df: score_completions(df, **options), target, checkpoint, once=once
    )
