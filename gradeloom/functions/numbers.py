"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(value: Column) -> Column:
    """Shortest decimal form of a double: ``0.5``, ``12.0``, ``1e-07``, ``1e+16``."""
    size = F.abs(value)
    java = value.cast("string")
    # Plain notation from 0.0001 up to 1e16, where the cast already gives an exponent.
    plain = F.regexp_replace(value.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+\z", "$1")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0\z", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(F.contains(java, F.lit("E")) & ((size >= 1e16) | (size < 1e-4)), scientific)
        .when(F.contains(java, F.lit("E")), plain)
        .otherwise(java)
    )
