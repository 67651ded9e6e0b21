"""Prefix limits and slices by input ordinal."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Histogram buckets per pass as a power of two. Twelve bits find any 64-bit ordinal
# in at most six passes.
_BUCKET_BITS = 12
_SPLIT = re.compile(r"(?P<name>[^\[\]]+)(?:\[(?P<start>\d*):(?P<stop>\d*)\])?")


def nth_ordinal(df: DataFrame, n: int, ord_col: str = "ord") -> int | None:
    """The ``n``-th smallest value (from 1) of a whole-number column.

    None when there are fewer than ``n`` rows. A null, or a value repeated across the
    cut, is an error, as no prefix would have ``n`` rows. Each pass counts the remaining value
    range in at most 4096 buckets, reading the ordinal column only; the driver sees
    those counts and no rows.
    """
    ordinal = F.col(ord_col).cast("long")
    low, high, total, rows = df.agg(F.min(ordinal), F.max(ordinal), F.count(ordinal), F.count(F.lit(1))).first()
    if total < rows:
        raise ValueError(f"{ord_col} has nulls")
    if total < n:
        return None
    wanted = n
    if high - low >= 1 << 63:
        # The distance would not fit in 64 bits: settle the sign first.
        negatives = df.where(ordinal < 0).count()
        low, high = (low, -1) if wanted <= negatives else (0, high)
        wanted -= 0 if high == -1 else negatives
    while low < high:
        shift = max((high - low).bit_length() - _BUCKET_BITS, 0)
        bucket = F.shiftright((ordinal - F.lit(low)).cast("long"), shift).alias("bucket")
        counts = df.where(ordinal.between(low, high)).groupBy(bucket).count().collect()
        for index, count in sorted(counts):
            if wanted <= count:
                low += index << shift
                high = min(high, low + (1 << shift) - 1)
                break
            wanted -= count
    if df.where(ordinal <= low).count() != n:
        raise ValueError(f"{ord_col} is not unique: {low} occurs more than once")
    return low


def slice_rows(
    df: DataFrame, start: int = 0, stop: int | None = None, ord_col: str = "ord"
) -> DataFrame:
    """Rows ``start`` to ``stop - 1`` in input order, counted from 0.

    Becomes a range filter on the ordinal, which reaches the file scan: rows are
    neither sorted nor moved, and no single task sees them all. The ordinal must be
    unique.
    """
    if stop is not None and stop <= start:
        return df.limit(0)
    kept = df
    if start > 0:
        floor = nth_ordinal(df, start, ord_col)
        if floor is None:
            return df.limit(0)
        kept = kept.where(F.col(ord_col) > F.lit(floor))
    if stop is not None:
        ceiling = nth_ordinal(df, stop, ord_col)
        if ceiling is not None:
            kept = kept.where(F.col(ord_col) <= F.lit(ceiling))
    return kept


def prefix_limit(df: DataFrame, n: int | None, ord_col: str = "ord") -> DataFrame:
    """The first ``n`` rows in input order; all rows for None."""
    return slice_rows(df, 0, n, ord_col)


def parse_split(split: str) -> tuple[str, int, int | None]:
    """Split name, first row and end row of ``name`` or ``name[a:b]``."""
    parsed = _SPLIT.fullmatch(split.strip())
    if parsed is None:
        raise ValueError(f"not a split name or slice: {split!r}")
    stop = parsed["stop"]
    return parsed["name"], int(parsed["start"] or 0), int(stop) if stop else None
