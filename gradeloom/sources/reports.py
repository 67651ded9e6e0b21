"""Small results as files, and the dataset registry."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.operators.tables import upsert
from gradeloom.runtime import child_names, create_once, delete_path
from gradeloom.schemas import REGISTRY

_VERSION, _COMMITS = "version=", "commits"
# Looks at a commit that is being written.
_PATIENCE = 50


def write_csv(df: DataFrame, path: str) -> str:
    """Write with a header line. Large tables stay spread over several files."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_summary(summary: DataFrame, path: str) -> str:
    """Write a summary table as JSON; a summary is a handful of rows."""
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_report(lines: DataFrame, path: str) -> str:
    """Write ``position, line`` rows of a report as one text file in order."""
    ordered = lines.coalesce(1).sortWithinPartitions("position").select(F.col("line").alias("value"))
    ordered.write.mode("overwrite").text(path)
    return path


def _head(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number of the last commit to a registry and the folder it names; 0 and None before the first."""
    numbers = [int(name) for name in child_names(spark, f"{path}/{_COMMITS}") if name.isdigit()]
    for number in sorted(numbers, reverse=True)[:1]:
        for _ in range(_PATIENCE):
            line = spark.read.text(f"{path}/{_COMMITS}/{number:08d}").first()
            if line is not None:
                return number, f"{path}/{line.value}"
            time.sleep(0.1)  # made, but not yet written
        raise RuntimeError(f"commit {number} below {path} was never finished; delete it")
    return 0, None


def _entries(spark: SparkSession, folder: str | None) -> DataFrame:
    return spark.createDataFrame([], REGISTRY) if folder is None else spark.read.schema(REGISTRY).parquet(folder)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Current entries of the dataset registry at ``path``; empty when there is none."""
    return _entries(spark, _head(spark, path)[1])


def register_datasets(
    spark: SparkSession, path: str, entries: DataFrame, order: str | None = None, tries: int = 20
) -> str:
    """Put entries into the registry by name; with ``order`` the last one of a name wins.

    Writes a new version beside the old ones and then claims the next commit number for
    it, which only one writer can. Whoever comes second takes in what the first has
    committed and tries again, so no writer's entries are lost. A failed write changes
    nothing and a reader never sees half of one.
    """
    for _ in range(tries):
        number, folder = _head(spark, path)
        version = f"{_VERSION}{uuid.uuid4().hex}"
        upsert(_entries(spark, folder), entries, order=order).write.parquet(f"{path}/{version}")
        if create_once(spark, f"{path}/{_COMMITS}/{number + 1:08d}", version):
            return f"{path}/{version}"
        delete_path(spark, f"{path}/{version}")
    raise RuntimeError(f"other writers were first {tries} times in a row below {path}")


def registry_entries(
    spark: SparkSession, files: dict[str, str] | DataFrame, layout: dict, keep: Sequence[str] = ()
) -> DataFrame:
    """Registry rows for exported files that share a layout.

    ``files`` names the file of each dataset: a few of them as a dictionary, or a table with
    ``name``, ``file_name`` and the columns to ``keep``, such as the order of changes.
    """
    if isinstance(files, dict):
        files = spark.createDataFrame(list(files.items()), "name string, file_name string")
    columns = F.create_map(*[F.lit(text) for pair in layout["columns"].items() for text in pair])
    return files.select(
        "name",
        "file_name",
        F.lit(layout["formatting"]).alias("formatting"),
        F.lit(layout["ranking"]).cast("boolean").alias("ranking"),
        columns.alias("columns"),
        *keep,
    )
