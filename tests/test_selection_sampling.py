import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeloom.operators import ordered, sampling, selection


def test_ordered_bits_keep_the_order(spark):
    values = [float("-inf"), -1e300, -2.5, -1e-310, 0.0, 5e-324, 1.0, 1.5, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in [*values, -0.0]], "v double").select("v", selection.ordered_bits(F.col("v")).alias("b"))
    rows = df.withColumn("back", selection.from_ordered_bits(F.col("b"))).collect()
    bits = [r.b for r in rows]
    assert bits[:-1] == sorted(bits[:-1]) and bits[-1] == bits[4]
    assert all(r.back == r.v or (math.isnan(r.v) and math.isnan(r.back)) for r in rows)


def test_nth_values_of_many_groups(spark):
    rng = random.Random(4)
    rows, groups = [], {}
    for g in ["a", "b", None, "hot"]:
        for _ in range(5 if g == "a" else 300):
            x = rng.choice([rng.randrange(-(1 << 63), 1 << 63), rng.randrange(-3, 3), -(1 << 63), (1 << 63) - 1])
            w = rng.randrange(1, 4)
            rows.append((g, x, w))
            groups.setdefault(g, []).extend([x] * w)
    wanted = [(g, n) for g, each in groups.items() for n in {1, 2, len(each) // 2, len(each)}]
    df = spark.createDataFrame(rows, "g string, x long, w long")
    found = selection.nth_values(df, ["g"], "x", "w", spark.createDataFrame(wanted, "g string, n long"), "n").collect()
    assert len(found) == len(wanted)
    for r in found:
        each = sorted(groups[r.g])
        assert r.x == each[r.n - 1] and r.left == r.n - each.index(r.x)
    with pytest.raises(ValueError):
        selection.nth_values(df, [], "x", "w", df, "w")


def test_median_equals_sorting(spark):
    rows = [("a", v) for v in (3.0, -1.0, 3.0, None)] + [("b", v) for v in (1.0, 2.0, -0.0, 0.0)] + [("c", None), (None, 7.5)]
    rows += [("d", float("inf")), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in ordered.exact_median(df, ["k"], "v", "m").collect()}
    assert got == {"a": 3.0, "b": 0.5, None: 7.5, "d": float("inf")}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 5)), min_size=1, max_size=6), st.integers(0, 150))
def test_quotas_are_whole_and_exact(parts, total):
    sizes, weights = [p[0] for p in parts], [p[1] for p in parts]
    quotas = sampling.shared_quotas(sizes, weights, total)
    assert sum(quotas) == min(total, sum(sizes))
    assert all(0 <= q <= s for q, s in zip(quotas, sizes))
    # Where neither is full, shares follow the weights to within the rounding.
    for i, q in enumerate(quotas):
        for j, r in enumerate(quotas):
            if q < sizes[i] and r < sizes[j] and weights[i] and weights[j]:
                assert abs(q / weights[i] - r / weights[j]) <= 2


def test_harder_subset(spark):
    rows = [(f"p{i}", (i % 11) / 10) for i in range(1100)] + [("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "prompt string, difficulty double")
    chosen = sampling.harder_subset(df, 400).collect()
    strata = Counter(r.stratum for r in chosen)
    # 301 rows are in the hardest stratum, 300, 300 and 200 in the others.
    assert strata == {0: 40, 1: 80, 2: 120, 3: 160} and len({r.prompt for r in chosen}) == 400
    again = sampling.harder_subset(df.repartition(7), 400).collect()
    assert {r.prompt for r in again} == {r.prompt for r in chosen}
    more = {r.prompt for r in sampling.harder_subset(df, 600).collect()}
    assert {r.prompt for r in chosen} <= more
    everything = sampling.harder_subset(df, 10_000).collect()
    assert len(everything) == 1101 and "none" not in {r.prompt for r in everything}
    assert sampling.harder_subset(df, 0).count() == 0 and sampling.harder_subset(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        sampling.harder_subset(df, 5, weights=(1, 2))


def test_equal_numbers_go_by_key(spark):
    df = spark.createDataFrame([(0, f"k{i:02d}", i % 2) for i in range(20)] + [(1, "x", 0)], "g int, k string, same int")
    quotas = spark.createDataFrame([(0, 13), (1, 0)], "g int, q long")
    got = selection.first_of_groups(df, "g", "k", F.col("same"), quotas, "q").collect()
    assert sorted(r.k for r in got) == sorted([f"k{i:02d}" for i in range(0, 20, 2)] + ["k01", "k03", "k05"])


def test_difficulty_is_mean_failure(spark):
    rows = [("a", 1.0), ("a", 0.0), ("a", None), ("b", 0.0), ("c", None)]
    out = sampling.prompt_difficulty(spark.createDataFrame(rows, "prompt string, correctness_reward double"))
    assert {r.prompt: (r.completions, r.difficulty) for r in out.collect()} == {"a": (2, 0.5), "b": (1, 1.0), "c": (0, None)}
