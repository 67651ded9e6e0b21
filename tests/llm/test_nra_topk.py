import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm.nra_topk import SortedLists, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k, every):
    whole = {}
    for i, v, *_ in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole[(i, tuple(np.float32(v)))] = [int(np.floor(256 * float(np.float32(x)))) for x in v]
    out = []
    for (q, _), a in whole.items():
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for (i, _), b in whole.items() if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    found = top_k(df, F.col("vec_id") % 10 == 0, 5, **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block_rows,query_rows", [(8192, 4096), (40, 3)])
def test_matches_brute_force(spark, block_rows, query_rows):
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.normal(size=16) / 4], 0, "x") for i in range(300)]
    rows += [(1000 + i, rows[5][1], 0, "copy") for i in range(60)]  # a vector that many share
    assert run(spark, rows, block_rows=block_rows, query_rows=query_rows) == brute(rows, 5, 10)


def test_unusable_vectors_ties_and_repeats(spark):
    rows = [
        (0, [1.0, 0.5], 0, "a"),
        (1, [0.5, 0.5], 0, "b"),
        (2, [0.5, 0.5], 0, "tie"),
        (2, [0.5, 0.5], 0, "repeated row"),
        (3, None, 0, ""),
        (4, [1.0, None], 0, ""),
        (5, [float("nan"), 1.0], 0, ""),
        (6, [float("inf"), 1.0], 0, ""),
        (7, [], 0, ""),
        (8, [1.0, 1.0, 1.0], 0, "other length"),
        (None, [1.0, 1.0], 0, ""),
        (10, [0.0, 0.0], None, None),
    ]
    found = run(spark, rows)
    assert found == brute(rows, 5, 10)
    assert [r[2] for r in found if r[0] == 0] == [1, 2, 10]


def test_empty(spark):
    assert run(spark, []) == []


def test_bounds_hold_at_every_depth():
    random = np.random.default_rng(2)
    vectors = random.integers(-200, 200, (50, 6))
    vectors[10:20] = vectors[0]
    queries = random.integers(-200, 200, (7, 6)).astype(float)
    lists = SortedLists(np.arange(50), vectors)
    exact = queries @ vectors.T
    for depth in range(1, 51):
        lower, upper = lists.bounds(queries, depth)
        assert (lower <= exact + 1e-6).all() and (upper >= exact - 1e-6).all()
    assert np.allclose(lower, exact) and np.allclose(upper, exact)


def test_scores_beyond_64_bits_are_refused():
    lists = SortedLists(np.arange(2), np.array([[1 << 40, 0], [0, 1 << 40]]))
    with pytest.raises(ValueError):
        list(lists.search(np.array([9]), np.array([[1 << 40, 1]]), 1))
