"""Order-dependent work over groups of any size.

A plain window puts a whole group into one task, and a group may hold a third of the
table. So rows are first spread by ranges of (keys, order), which Spark balances by
sampling, and the number of each row's range is kept with it in a reliable checkpoint. A
window then covers one group within one range, which is at most what one task holds,
and what a range needs from the ones before it travels in a table of one row per group
and range. Large and small groups take the same path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.selection import median_of_counts
from gradeloom.runtime import prepare_checkpoints, stored

_KEY = "__order_key"
_RANGE = "__order_range"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal keys, null keys included; the right side has one row per key."""
    other = right.withColumnsRenamed({key: f"__k_{key}" for key in keys})
    condition = left[keys[0]].eqNullSafe(other[f"__k_{keys[0]}"])
    for key in keys[1:]:
        condition = condition & left[key].eqNullSafe(other[f"__k_{key}"])
    return left.join(other, condition, "left").drop(*[f"__k_{key}" for key in keys])


class OrderedGroups:
    """Rows of a table with each group cut into consecutive, task-sized ranges.

    ``order`` must be unique within a group; all its columns sort ascending.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> None:
        if not keys:
            raise ValueError("grouping needs at least one key column")
        prepare_checkpoints(df.sparkSession)
        self.keys = list(keys)
        keyed = df.withColumn(_KEY, F.struct(*[part.alias(f"o{i}") for i, part in enumerate(order)]))
        ranged = keyed.repartitionByRange(*self.keys, _KEY).withColumn(_RANGE, F.spark_partition_id())
        self.rows = ranged.checkpoint()

    @property
    def window(self):
        """Window over the rows of a group in one range, in order."""
        return Window.partitionBy(*self.keys, _RANGE).orderBy(_KEY)

    @property
    def so_far(self):
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(_KEY, _RANGE, "__carry")

    def with_carry(self, df: DataFrame, partial: Column, carry_over) -> DataFrame:
        """Add ``__carry``: ``partial`` of each range combined over earlier ranges.

        ``carry_over(column, window)`` combines the values of a group's ranges, of which
        there are at most as many as tasks.
        """
        per_range = self.rows.groupBy(*self.keys, _RANGE).agg(partial.alias("__part"))
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy(_RANGE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = per_range.withColumn("__carry", carry_over(F.col("__part"), earlier))
        return same_keys(df, carried.drop("__part"), [*self.keys, _RANGE])


def _sum_before(part: Column, earlier) -> Column:
    return F.coalesce(F.sum(part).over(earlier), F.lit(0))


def with_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], output: str = "rank"
) -> DataFrame:
    """Add the 1-based position of each row in its group."""
    groups = OrderedGroups(df, keys, order)
    local = groups.rows.withColumn(output, F.row_number().over(groups.window).cast("long"))
    carried = groups.with_carry(local, F.count(F.lit(1)), _sum_before)
    return groups.finish(carried.withColumn(output, F.col(output) + F.col("__carry")))


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, output: str
) -> DataFrame:
    """Add the sum of a whole-number column over the group up to each row."""
    groups = OrderedGroups(df, keys, order)
    local = groups.rows.withColumn(output, F.sum(value).over(groups.so_far))
    carried = groups.with_carry(local, F.sum(value), _sum_before)
    return groups.finish(carried.withColumn(output, F.col(output) + F.col("__carry")))


def with_last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
    prefix: str = "last_",
) -> DataFrame:
    """Add the last non-null value of each column over the group up to each row."""
    groups = OrderedGroups(df, keys, order)
    local = groups.rows.withColumns(
        {f"{prefix}{v}": F.last(v, ignorenulls=True).over(groups.so_far) for v in values}
    )
    latest = F.struct(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(_KEY))).alias(v) for v in values]
    )
    carried = groups.with_carry(
        local,
        latest,
        lambda part, earlier: F.struct(
            *[F.last(part[v], ignorenulls=True).over(earlier).alias(v) for v in values]
        ),
    )
    filled = carried.withColumns(
        {f"{prefix}{v}": F.coalesce(F.col(f"{prefix}{v}"), F.col("__carry")[v]) for v in values}
    )
    return groups.finish(filled)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, output: str) -> DataFrame:
    """Exact median per group, the mean of the middle two for an even count.

    Equal values are counted before anything is selected, so each distinct value is seen
    once however often it occurs.
    """
    counted = stored(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "values")
    return median_of_counts(counted, keys, value, "__n", output)


def with_group_values(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Add aggregates of the whole group to each of its rows.

    A partial aggregate and a join on the keys; the side of the aggregate has one row per
    group, so a large group on the other side can be split. ``df`` is read twice: store it
    if it is costly.
    """
    if not keys:
        raise ValueError("grouping needs at least one key column")
    reduced = df.groupBy(*keys).agg(*[value.alias(name) for name, value in values.items()])
    return same_keys(df, reduced, keys)


def with_ordinal(df: DataFrame, order: Sequence[str | Column], output: str = "ord") -> DataFrame:
    """Number all rows from 0 in the given order.

    Sorts by range over all tasks and keeps the result as a reliable checkpoint, so
    the row counts that give each partition its start value stay true to the rows
    even when executors are lost. ``order`` must be unique.
    """
    prepare_checkpoints(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    position = F.monotonically_increasing_id()
    marked = ranged.withColumns(
        {
            "__part": F.shiftright(position, 33),
            "__at": position.bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    # One row per partition.
    sizes = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    return (
        marked.join(F.broadcast(starts), "__part")
        .withColumn(output, F.col("__start") + F.col("__at"))
        .drop("__part", "__at", "__start")
    )
