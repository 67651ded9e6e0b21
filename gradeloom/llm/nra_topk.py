"""Exact top-k search by aggregation without random access.

Every component of a vector is a list of candidates sorted by that component. For a
query, a positive weight reads its list from the top and a negative one from the
bottom. After reading all lists to some depth, a candidate's score lies between its
known part plus the worst values still possible and its known part plus the values at
the reading position. Reading stops when few candidates can still reach the k-th best
lower bound; their scores are then resolved exactly. Blocks of candidates meet blocks
of queries, so no task holds a whole side, and each block keeps its k best.

Vectors that are null, empty, or hold a null or non-finite component take no part, nor
do rows without id. Vectors of different lengths are not compared. Equal (id, vector)
rows count once. A query never finds rows with its own id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DEPTHS = (0.25, 0.45, 0.65, 0.85)
_QUERY_STEP = 64
_RESULT = "query_key long, query_id long, vec_id long, score long"
# Above this sum doubles no longer hold whole numbers exactly.
_EXACT = float(1 << 53)


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """Usable vectors as whole numbers: ``floor(scale * component)``."""
    wide = F.transform(vec_col, lambda x: x.cast("double"))
    usable = (
        F.col(id_col).isNotNull()
        & F.col(vec_col).isNotNull()
        & (F.size(vec_col) > 0)
        & F.forall(wide, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    )
    whole = F.transform(wide, lambda x: F.floor(x * scale))
    return df.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vec")).distinct()


class SortedLists:
    """A block of candidates with every component as a sorted list."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.columns = np.ascontiguousarray(vectors.T.astype(np.float64))
        self.lists = np.sort(self.columns, axis=1)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper score bounds after reading ``depth`` entries of each list.

        What a read entry adds over the value at the reading position is
        ``max(v - position, 0)`` and 0 for an unread one, so that the upper bound is a
        product with these differences plus the bound of a candidate not seen at all.
        """
        at_top, at_bottom = self.lists[:, -depth][:, None], self.lists[:, depth - 1][:, None]
        least, most = self.lists[:, :1], self.lists[:, -1:]
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        upper = plus @ np.maximum(self.columns - at_top, 0) + minus @ np.minimum(self.columns - at_bottom, 0)
        upper += plus @ at_top + minus @ at_bottom
        lower = plus @ np.where(self.columns >= at_top, self.columns - least, 0)
        lower += minus @ np.where(self.columns <= at_bottom, self.columns - most, 0)
        lower += plus @ least + minus @ most
        return lower, upper

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yield (query position, candidate positions, exact scores) of the k best each."""
        n = len(self.ids)
        open_rows, weights = np.arange(len(ids)), queries.astype(np.float64)
        size = np.abs(self.columns).max(initial=0) * np.abs(weights).max(initial=0) * max(len(self.columns), 1)
        slack = 0.0 if size < _EXACT else size * 1e-12
        if size >= 2.0**62:
            raise ValueError("inner products would not fit 64 bits")
        for depth in [max(1, int(n * part)) for part in _DEPTHS] + [n]:
            if not len(open_rows):
                return
            lower, upper = self.bounds(weights[open_rows], depth)
            own = self.ids[None, :] == ids[open_rows][:, None]
            lower[own], upper[own] = -np.inf, -np.inf
            if n > k:
                kth = np.partition(lower, n - k, axis=1)[:, n - k]
            else:
                kth = np.full(len(open_rows), -np.inf)
            left = (upper >= kth[:, None] - slack) & ~own
            few = (left.sum(1) <= max(8 * k, n // 32)) | (depth == n)
            for i in np.flatnonzero(few):
                rest = np.flatnonzero(left[i])
                scores = self.vectors[rest] @ queries[open_rows[i]]
                best = np.lexsort((self.ids[rest], -scores))[:k]
                yield int(open_rows[i]), rest[best], scores[best]
            open_rows = open_rows[~few]


def _search_block(k: int):
    def run(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        for length, own_queries in queries.groupby(queries["vec"].str.len()):
            fitting = candidates[candidates["vec"].str.len() == length]
            if fitting.empty:
                continue
            lists = SortedLists(fitting["vec_id"].to_numpy(np.int64), np.stack(fitting["vec"]).astype(np.int64))
            ids, keys = own_queries["vec_id"].to_numpy(np.int64), own_queries["query_key"].to_numpy(np.int64)
            vectors = np.stack(own_queries["vec"]).astype(np.int64)
            for at in range(0, len(ids), _QUERY_STEP):
                part = slice(at, at + _QUERY_STEP)
                for row, found, scores in lists.search(ids[part], vectors[part], k):
                    q = at + row
                    out += [(keys[q], ids[q], v, s) for v, s in zip(lists.ids[found], scores)]
        return pd.DataFrame(out, columns=["query_key", "query_id", "vec_id", "score"], dtype="int64")

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 256,
    block_rows: int = 8192,
    query_rows: int = 4096,
) -> DataFrame:
    """The ``k`` highest inner products of every query row against all other rows.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id. Returns
    query_id, rank, vec_id, score.
    """
    rows = whole_vectors(vectors, id_col, vec_col, scale)
    queries = rows.where(is_query).withColumn("query_key", F.xxhash64("vec_id", "vec"))
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, query_blocks = max(1, -(-total // block_rows)), max(1, -(-asked // query_rows))
    row_hash = F.xxhash64("vec_id", "vec")
    left = rows.withColumns(
        {"cb": F.pmod(row_hash, F.lit(blocks)).cast("int"), "qb": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))}
    )
    right = queries.withColumns(
        {"qb": F.pmod(row_hash, F.lit(query_blocks)).cast("int"), "cb": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))}
    )
    found = left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInPandas(_search_block(k), _RESULT)
    best = Window.partitionBy("query_key", "query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
