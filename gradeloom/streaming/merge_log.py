"""Tables that a stream keeps up to date by small versions which readers merge.

Every batch writes the reduced state of its own rows only, as a version named by the batch;
what is read is the newest base merged with all later versions. From time to time a batch
also merges everything so far into a new base, and what the base before it has replaced goes.
A batch that is run again replaces its own version, and a version counts once it is complete, so
neither a killed nor a repeated batch counts twice or half.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from gradeloom.runtime import child_names, delete_path, is_complete

Reduce = Callable[[DataFrame], DataFrame]
_BATCH, _BASE = "batch=", "base="


class MergeLog:
    """State per key below ``target``.

    ``partial`` reduces rows to one row per key and ``merge`` several of those to one; merging must
    not depend on order. A base is written every ``every`` batches.
    """

    def __init__(self, target: str, partial: Reduce, merge: Reduce, every: int = 10) -> None:
        if every < 1:
            raise ValueError("a base is due every 1 or more batches")
        self.target, self.partial, self.merge, self.every = target.rstrip("/"), partial, merge, every

    def _path(self, kind: str, number: int) -> str:
        return f"{self.target}/{kind}{number:012d}"

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        names = [name for name in child_names(spark, self.target) if name.startswith(kind)]
        return sorted(int(name[len(kind) :]) for name in names)

    def _complete(self, spark: SparkSession, kind: str, below: int | None = None) -> list[int]:
        numbers = [n for n in self._numbers(spark, kind) if below is None or n < below]
        return [n for n in numbers if is_complete(spark, self._path(kind, n))]

    def _versions(self, spark: SparkSession, below: int | None = None) -> list[str]:
        """Paths whose merge is the state: a base and what came after it."""
        bases = self._complete(spark, _BASE, below)
        base = max(bases, default=-1)
        later = [n for n in self._complete(spark, _BATCH, below) if n > base]
        return [self._path(_BASE, n) for n in [base] if n >= 0] + [self._path(_BATCH, n) for n in later]

    def add(self, rows: DataFrame, batch: int) -> None:
        """Take in the rows of a batch; for ``foreachBatch``."""
        spark = rows.sparkSession
        bases = self._complete(spark, _BASE)
        # A base holds all batches up to its own: one that is repeated after it is in there.
        if bases and batch < max(bases):
            return
        self.partial(rows).write.mode("overwrite").parquet(self._path(_BATCH, batch))
        if (batch + 1) % self.every == 0:
            self._rebase(spark, batch)

    def _rebase(self, spark: SparkSession, batch: int) -> None:
        parts = [*self._versions(spark, below=batch), self._path(_BATCH, batch)]
        self._merged(spark, parts).write.mode("overwrite").parquet(self._path(_BASE, batch))
        # The base before this one and its batches stay for readers that have begun.
        before = max(self._complete(spark, _BASE, below=batch), default=-1)
        for kind in (_BATCH, _BASE):
            for number in self._numbers(spark, kind):
                if number < before or (kind == _BATCH and number == before):
                    delete_path(spark, self._path(kind, number))

    def _merged(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return self.merge(reduce(DataFrame.unionByName, [spark.read.parquet(path) for path in paths]))

    def read(self, spark: SparkSession) -> DataFrame:
        """The state of all complete batches, one row per key."""
        paths = self._versions(spark)
        if not paths:
            raise FileNotFoundError(f"no complete version below {self.target}")
        return self._merged(spark, paths)
