"""Named datasets, in-memory rows and calibration prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.fixed import FALLBACK_CALIBRATION_PROMPTS
from gradeloom.operators.limits import parse_split, prefix_limit, slice_rows
from gradeloom.runtime import path_exists
from gradeloom.sources.jsonl import load_if_complete, read_jsonl

_SPLIT_COLUMN = "split"


def _is_path(name: str) -> bool:
    return "/" in name


def _read_path(
    spark: SparkSession, path: str, schema: T.StructType | str | None
) -> DataFrame:
    if path.rstrip("/").endswith((".json", ".jsonl")):
        if schema is None:
            raise ValueError("reading JSON needs a schema")
        return read_jsonl(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def load_dataset(
    spark: SparkSession,
    name: str,
    split: str,
    config: str | None = None,
    schema: T.StructType | str | None = None,
    ord_col: str = "ord",
) -> DataFrame:
    """A split of a dataset, or a slice of it as in ``train[:512]``.

    ``name`` is a folder or a catalog table. A folder holds one Parquet or JSON Lines
    file or folder per split, below a folder per config where there are several; a
    table (or a folder partitioned by it) has a ``split`` column, which prunes the
    scan. Slices count in the order of ``ord_col``.
    """
    split_name, start, stop = parse_split(split)
    if _is_path(name):
        base = "/".join(part.rstrip("/") for part in (name, config) if part)
        options = [f"{base}/{split_name}{suffix}" for suffix in ("", ".parquet", ".jsonl", ".json")]
        found = next((path for path in options if path_exists(spark, path)), None)
        table = _read_path(spark, found or base, schema)
    else:
        table = spark.table(f"{name}_{config}" if config else name)
        found = None
    if found is None:
        # Without the column every split would be the whole table.
        if _SPLIT_COLUMN not in table.columns:
            raise ValueError(f"{name} has no {_SPLIT_COLUMN!r} column to find split {split_name!r} by")
        table = table.where(F.col(_SPLIT_COLUMN) == split_name)
    return table if start == 0 and stop is None else slice_rows(table, start, stop, ord_col)


def stream_dataset(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", **options: str
) -> DataFrame:
    """The same rows as an unbounded table that picks up new files."""
    return spark.readStream.schema(schema).options(**options).format(file_format).load(path)


def from_records(
    spark: SparkSession, records: Sequence[dict | Row], schema: T.StructType | str, ord_col: str | None = None
) -> DataFrame:
    """Table of rows held by the caller, numbered in their order if asked for."""
    if ord_col is None:
        return spark.createDataFrame(records, schema)
    base = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*base.fields, T.StructField(ord_col, T.LongType())])
    return spark.createDataFrame([{**dict(row), ord_col: i} for i, row in enumerate(records)], full)


def calibration_prompts(
    spark: SparkSession, path: str, limit: int, schema: T.StructType | str, ord_col: str = "ord"
) -> DataFrame:
    """The first ``limit`` prompts of a prepared table, or two standing ones without it."""
    table = load_if_complete(spark, path, schema)
    if table is None:
        return spark.createDataFrame([(text,) for text in FALLBACK_CALIBRATION_PROMPTS], "prompt string")
    return first_prompts(table, limit, ord_col)


def first_prompts(table: DataFrame, limit: int, ord_col: str = "ord") -> DataFrame:
    """The first ``limit`` prompts of a table."""
    return prefix_limit(table, limit, ord_col).select("prompt")
