"""Keyed upsert, union of sources and train/validation split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.normalize import normalize_sft

_SPLIT_SLOTS = 10_000


def upsert(
    current: DataFrame, changes: DataFrame, key: str = "name", order: str | None = None
) -> DataFrame:
    """``current`` with the rows of ``changes`` put in by key, others kept.

    Of several changes to a key the one with the highest ``order`` wins; that column is
    not kept. Without it a repeated key is an error, as no row is the last.
    """
    if order is not None:
        names = [name for name in changes.columns if name not in (key, order)]
        last = F.max_by(F.struct(*names), order).alias("__last")
        changes = changes.groupBy(key).agg(last).select(key, "__last.*")
    else:
        repeated = changes.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").first()
        if repeated is not None:
            raise ValueError(f"{key} {repeated[0]!r} is changed more than once; name an order column")
    return current.join(changes, key, "left_anti").unionByName(changes, allowMissingColumns=True)


def unify_sources(sources: dict[str, DataFrame], ord_col: str = "ord") -> DataFrame:
    """Unified records of several raw tables in one table, tagged with their source."""
    parts = [normalize_sft(df, name, ord_col=ord_col) for name, df in sources.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def split_slot(key: str) -> Column:
    """Stable slot from 0 to 9999 of a key, equal in any engine that has MD5."""
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(_SPLIT_SLOTS))


def is_validation(key: str, ratio: float) -> Column:
    """True for the share ``ratio`` of keys that go to the validation side."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must lie between 0 and 1")
    if 0 < ratio < 0.5 / _SPLIT_SLOTS:
        raise ValueError(f"a ratio below {0.5 / _SPLIT_SLOTS} would give an empty side")
    return split_slot(key) < F.lit(round(ratio * _SPLIT_SLOTS))


def split_train_validation(
    df: DataFrame, key: str, ratio: float
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and validation tables; a key always falls on the same side."""
    held_out = is_validation(key, ratio)
    return df.where(~held_out), df.where(held_out)
