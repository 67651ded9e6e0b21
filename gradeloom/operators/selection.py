"""The n-th smallest value of every group, without sorting.

A radix selection: each pass counts one digit of 16 bits of the values that share the
digits found so far, for all groups in one aggregate, and keeps the digit in which the
wanted position falls. Four passes find any 64-bit number. Between passes there is one row
per group; a pass sees at most 65,536 digits of a group, so no group is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.runtime import stored

_DIGIT = 16
_PASSES = 64 // _DIGIT
_BIT_SIGN = 1 << 63


def ordered_bits(value: Column) -> Column:
    """A double as a whole number in the same order; NaN is the largest, -0.0 is 0.0."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    # Negative numbers stand in the opposite order of their bits.
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(_BIT_SIGN - 1))).otherwise(bits)


def from_ordered_bits(bits: Column) -> Column:
    """The double that :func:`ordered_bits` made a number of."""
    raw = F.when(bits < 0, bits.bitwiseXOR(F.lit(_BIT_SIGN - 1))).otherwise(bits)
    return F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")


def nth_values(df: DataFrame, keys: Sequence[str], number: str, weight: str, wanted: DataFrame, n: str) -> DataFrame:
    """``wanted`` with the value at position ``n`` of its group, and what is left of ``n`` there.

    ``df`` counts each row ``weight`` times and should be stored, as every pass reads it. ``number``
    is a 64-bit whole number without nulls. ``wanted`` has the keys, ``n`` (from 1, at most the
    group's weight) and may have further columns, which stay; a group may be asked for
    several positions. Adds ``number``, the value there, and ``left``, how many of the rows with that
    value lie at or before the position. Null keys are a group.
    """
    if not keys:
        raise ValueError("grouping needs at least one key column")
    names = [f"__key{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(name) for k, name in zip(keys, names)], F.col(number).alias("__x"), F.col(weight).alias("__w"))
    state = wanted.withColumns({"__found": F.lit(0).cast("long"), "__left": F.col(n).cast("long")})
    asked = wanted.columns
    for done in range(_PASSES):
        shift = 64 - _DIGIT * (done + 1)
        digit = F.shiftright("__x", shift)
        digit = digit if done == 0 else digit.bitwiseAND(F.lit((1 << _DIGIT) - 1))
        same = [F.col(name).eqNullSafe(state[k]) for k, name in zip(keys, names)]
        if done:
            same.append(F.shiftright("__x", shift + _DIGIT) == state["__found"])
        met = rows.join(state, same, "inner")
        counted = met.groupBy(*asked, "__found", "__left", digit.alias("__digit")).agg(F.sum("__w").alias("__rows"))
        upto = F.sum("__rows").over(Window.partitionBy(*asked).orderBy("__digit"))
        placed = counted.withColumn("__before", upto - F.col("__rows"))
        at = (F.col("__before") < F.col("__left")) & (F.col("__before") + F.col("__rows") >= F.col("__left"))
        found = F.col("__digit") if done == 0 else F.shiftleft("__found", _DIGIT).bitwiseOR(F.col("__digit"))
        state = placed.where(at).select(*asked, found.alias("__found"), (F.col("__left") - F.col("__before")).alias("__left"))
    return state.select(*asked, F.col("__found").alias(number), F.col("__left").alias("left"))


def median_of_counts(counted: DataFrame, keys: Sequence[str], value: str, count: str, output: str) -> DataFrame:
    """Exact median per group of a stored table with one row per distinct value and its count.

    The mean of the middle two for an even count. Null values do not take part.
    """
    known = counted.where(F.col(value).isNotNull()).withColumn("__bits", ordered_bits(F.col(value)))
    totals = known.groupBy(*keys).agg(F.sum(count).alias("__total"))
    middle = F.array(F.expr("(__total + 1) div 2"), F.expr("__total div 2 + 1"))
    wanted = totals.select(*keys, F.posexplode(middle).alias("__side", "__n"))
    found = nth_values(known, keys, "__bits", count, wanted, "__n")
    values = found.select(*keys, from_ordered_bits(F.col("__bits")).alias("__value"))
    return values.groupBy(*keys).agg(F.avg("__value").alias(output))


def first_of_groups(df: DataFrame, group: str, key: str, number: Column, quotas: DataFrame, quota: str) -> DataFrame:
    """Of each group the ``quota`` rows of the smallest numbers, equal numbers in the order of ``key``.

    ``quotas`` has one row per group with at most as many as the group has; groups without a row, or
    with 0, are left out. ``df`` should be stored; it is filtered, not sorted.
    """
    rows = df.withColumns({"__number": number.cast("long"), "__one": F.lit(1).cast("long")})
    wanted = quotas.where(F.col(quota) > 0).select(group, F.col(quota).alias("__n"))
    cuts = nth_values(rows, [group], "__number", "__one", wanted, "__n")
    cuts = cuts.select(F.col(group).alias("__group"), F.col("__number").alias("__cut"), F.col("left").alias("__left"))
    # One row per group.
    cuts = stored(cuts, "cuts")
    placed = rows.join(cuts, rows[group].eqNullSafe(cuts["__group"]))
    below = placed.where(F.col("__number") < F.col("__cut"))
    # Rows of one number only, so few unless the numbers repeat.
    order = Window.partitionBy(group, "__number").orderBy(key)
    at = placed.where(F.col("__number") == F.col("__cut")).withColumn("__at", F.row_number().over(order))
    both = below.unionByName(at.where(F.col("__at") <= F.col("__left")).drop("__at"))
    return both.select(*df.columns)
