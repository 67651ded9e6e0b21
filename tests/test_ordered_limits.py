"""Order-dependent operators, with and without very large groups, and limits."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gradeloom.operators import limits, ordered, pairs, runs

@pytest.fixture(scope="module")
def skewed(spark):
    """One prompt with a third of the rows, a null prompt, and many equal scores."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        prompt = "hot" if i % 3 == 0 else (None if i % 30 == 1 else f"p{rng.randint(0, 60)}")
        score = 1.0 if rng.random() < 0.5 else float(rng.randint(0, 4))
        rows.append((i * 7 % 900, prompt, score, rng.random() if rng.random() < 0.3 else None))
    df = spark.createDataFrame(rows, "ord long, prompt string, score double, value double").repartition(5)
    return df.cache(), rows


def groups_of(rows):
    out = {}
    for row in sorted(rows):
        out.setdefault(row[1], []).append(row)
    return out


def test_rank(skewed):
    df, rows = skewed
    ranked = ordered.with_rank(df, ["prompt"], [-F.col("score"), F.col("ord")])
    assert ranked.columns == [*df.columns, "rank"]
    expected = {
        row[0]: position
        for group in groups_of(rows).values()
        for position, row in enumerate(sorted(group, key=lambda r: -r[2]), 1)
    }
    got = ranked.collect()
    assert len(got) == len(rows)
    assert {r.ord: r.rank for r in got} == expected


@pytest.fixture
def small_ranges(spark):
    """Ranges as small as large tables make them for their size."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_no_range_holds_a_whole_large_group(skewed, small_ranges):
    df, _ = skewed
    groups = ordered.OrderedGroups(df, ["prompt"], [-F.col("score"), F.col("ord")])
    sizes = groups.rows.where("prompt = 'hot'").groupBy("__order_range").agg(
        F.count("*").alias("n"), F.min("__order_key").alias("low"), F.max("__order_key").alias("high")
    ).orderBy("__order_range").collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 300
    assert all(a.high < b.low for a, b in zip(sizes, sizes[1:]))


def test_many_equal_large_groups_and_one_group(spark, small_ranges):
    df = spark.range(6_000).select((F.col("id") * 11 % 6_000).alias("ord"), (F.col("id") % 6).alias("k"))
    ranked = ordered.with_rank(df, ["k"], [F.col("ord")])
    largest = ordered.OrderedGroups(df, ["k"], [F.col("ord")]).rows.groupBy("__order_range").count().agg({"count": "max"})
    assert largest.first()[0] < 1_000
    place = F.row_number().over(Window.partitionBy("k").orderBy("ord"))
    assert ranked.withColumn("want", place).where("rank <> want").count() == 0 and ranked.count() == 6_000
    one = ordered.with_rank(df.withColumn("k", F.lit(None).cast("string")), ["k"], [F.col("ord")])
    assert one.where("rank <> ord + 1").count() == 0 and one.count() == 6_000


def test_keys_are_required(spark):
    with pytest.raises(ValueError):
        ordered.with_rank(spark.range(3), [], [F.col("id")])
    with pytest.raises(ValueError):
        ordered.with_group_values(spark.range(3), [], {"n": F.count("id")})


def test_last_known(skewed):
    df, rows = skewed
    out = ordered.with_last_known(df, ["prompt"], [F.col("ord")], ["value"])
    expected = {}
    for group in groups_of(rows).values():
        last = None
        for row in group:
            last = row[3] if row[3] is not None else last
            expected[row[0]] = last
    assert {r.ord: r.last_value for r in out.collect()} == expected


def test_median(skewed):
    df, rows = skewed
    for column, index in (("score", 2), ("value", 3)):
        out = ordered.exact_median(df, ["prompt"], column, "m").collect()
        expected = {
            key: statistics.median(r[index] for r in group if r[index] is not None)
            for key, group in groups_of(rows).items()
            if any(r[index] is not None for r in group)
        }
        assert {r.prompt: r.m for r in out} == pytest.approx(expected)


def test_group_advantage(skewed):
    df, rows = skewed
    out = runs.group_advantage(df, reward="score").collect()
    assert len(out) == len(rows)
    for key, group in groups_of(rows).items():
        scores = [r[2] for r in group]
        mean, deviation = statistics.fmean(scores), statistics.pstdev(scores)
        mine = {r.ord: r.advantage for r in out if r.prompt == key}
        assert mine == pytest.approx({r[0]: (r[2] - mean) / (deviation + 1e-4) for r in group})


def test_latency_reads_its_input_once(skewed):
    df, _ = skewed
    counted = df.select("prompt", F.col("score").alias("latency_sec"), F.lit("a b").alias("text"))
    out = {r.prompt: r for r in runs.latency_summary(counted, by=("prompt",)).collect()}
    assert out["hot"].repeats == 300 and out[None].repeats > 0
    assert out["hot"].approx_tokens_per_sec == pytest.approx(2 / out["hot"].avg_latency_sec)


def test_ordinal(spark):
    rows = [(i * 37 % 500, "ab"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(rows, "n int, c string").repartition(7)
    out = ordered.with_ordinal(df, [F.col("c").desc(), F.col("n")]).collect()
    expected = sorted(rows, key=lambda r: (-ord(r[1]), r[0]))
    assert {(r.n, r.c): r.ord for r in out} == {row: i for i, row in enumerate(expected)}


@pytest.mark.parametrize(
    "values",
    [
        list(range(50)),
        [-(2**63), -5, 0, 7, 2**62, 2**63 - 1],
        [2**63 - 1 - i * i for i in range(40)],
        [-(2**63) + i * 10**12 for i in range(30)],
        [3],
    ],
)
def test_nth_ordinal(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ord long").repartition(3)
    ordered_values = sorted(values)
    for n in {1, 2, len(values) // 2, len(values) - 1, len(values)} - {0}:
        if n <= len(values):
            assert limits.nth_ordinal(df, n) == ordered_values[n - 1]
    assert limits.nth_ordinal(df, len(values) + 1) is None


def test_ordinals_must_be_unique_and_known(spark):
    repeated = spark.createDataFrame([(1,), (2,), (2,), (3,)], "ord int")
    assert limits.nth_ordinal(repeated, 1) == 1
    with pytest.raises(ValueError):
        limits.prefix_limit(repeated, 2)
    with pytest.raises(ValueError):
        limits.prefix_limit(spark.createDataFrame([(1,), (None,)], "ord int"), 1)


def test_narrow_ordinals_do_not_overflow(spark):
    df = spark.createDataFrame([(-2_000_000_000,), (0,), (2_000_000_000,)], "ord int")
    assert limits.nth_ordinal(df, 2) == 0


def test_slices(spark):
    df = spark.createDataFrame([(v * 10,) for v in range(30)], "ord long").repartition(4)

    def kept(result):
        return sorted(r.ord // 10 for r in result.collect())

    assert kept(limits.prefix_limit(df, 4)) == [0, 1, 2, 3]
    assert kept(limits.prefix_limit(df, None)) == list(range(30))
    assert kept(limits.prefix_limit(df, 0)) == []
    assert kept(limits.prefix_limit(df, 99)) == list(range(30))
    assert kept(limits.slice_rows(df, 28, 99)) == [28, 29]
    assert kept(limits.slice_rows(df, 5, 7)) == [5, 6]
    assert kept(limits.slice_rows(df, 30)) == []
    assert kept(limits.slice_rows(df, 40, 50)) == []
    assert kept(limits.slice_rows(df.limit(0), 0, 5)) == []


def test_limit_reaches_the_scan(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "ord").write.parquet(str(tmp_path / "t"))
    plan = limits.prefix_limit(spark.read.parquet(str(tmp_path / "t")), 10)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ord,9)" in plan and "Exchange" not in plan and "Limit" not in plan


def test_split_names():
    assert limits.parse_split("train") == ("train", 0, None)
    assert limits.parse_split("train[:512]") == ("train", 0, 512)
    assert limits.parse_split("test[3:]") == ("test", 3, None)
    with pytest.raises(ValueError):
        limits.parse_split("train[:10%]")


def test_rank_responses_cut(spark):
    df = spark.range(300).select(
        F.col("id").alias("ord"), F.lit("p").alias("prompt"), (F.col("id") % 2).cast("double").alias("score_chosen")
    )
    ranked = pairs.rank_responses(df)
    expected = F.when(F.col("ord") % 2 == 1, (F.col("ord") + 1) / 2).otherwise(150 + F.col("ord") / 2 + 1)
    assert ranked.where(F.col("rank") != expected).count() == 0 and ranked.count() == 300
