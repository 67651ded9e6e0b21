"""Evaluation summaries, run comparison, reports, splits and upserts."""

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import evaluation, runs, tables


@pytest.fixture
def predictions(spark):
    rows = [
        ("d1", "test", "q", "4", "思路：a\n步骤：b\n答案：4"),
        ("d1", "test", "q", "5", "思路：a\n答案：4"),
        ("d2", "test", "q", "", ""),
    ]
    return spark.createDataFrame(rows, "dataset string, split string, question string, answer string, prediction string")


def test_eval_rows(spark, predictions):
    rows = evaluation.eval_rows(predictions).collect()
    assert rows[0].asDict() == {
        "question": "q", "reference": "4", "prediction": "思路：a\n步骤：b\n答案：4", "predicted_answer": "4"
    }
    other = predictions.select(F.col("question").alias("problem"), F.lit("work #### 4").alias("gold"), "prediction")
    row = evaluation.eval_rows(other, "problem", "gold", gold_pattern=r"#### (.+)").first()
    assert (row.question, row.reference) == ("q", "4")
    assert evaluation.eval_rows(other, "absent", "absent").first().question == ""


def test_eval_summary(predictions):
    rows = evaluation.eval_rows(predictions, keep=("dataset", "split"))
    out = {r.dataset: r for r in evaluation.eval_summary(rows).collect()}
    assert (out["d1"].samples, out["d1"].final_answer_accuracy, out["d1"].format_pass_rate) == (2, 0.5, 0.5)
    assert (out["d2"].final_answer_accuracy, out["d2"].format_pass_rate) == (1.0, 0.0)
    low = evaluation.eval_summary(rows, by=(), threshold=0.5).first()
    assert (low.samples, low.format_pass_rate) == (3, 2 / 3)
    assert evaluation.final_answer_accuracy(rows).first()[0] == 2 / 3
    assert evaluation.format_pass_rate(rows, ["答案"]).first()[0] == 2 / 3


def test_empty_summary(predictions):
    rows = evaluation.eval_rows(predictions.limit(0))
    assert tuple(evaluation.eval_summary(rows, by=()).first()) == (0, 0.0, 0.0)
    assert evaluation.format_pass_rate(rows).first()[0] == 0.0


LOG = "run string, ord long, step long, mean_reward double, tokens_per_sec double, peak_memory_gb double"


@pytest.fixture
def log(spark):
    rows = [
        ("a", 3, 2, 0.5, None, None),
        ("a", 1, 1, 0.1, 10.0, None),
        ("a", 5, None, 0.9, 99.0, 9.0),  # belongs to no step
        ("a", 4, 2, None, None, None),
        ("b", 1, 2, 0.7, None, None),
        ("b", 2, 3, 1e-7, None, None),
        ("c", 1, 1, 5.0, 5.0, 5.0),
    ]
    return spark.createDataFrame(rows, LOG)


def test_latest(log):
    out = {r.run: r for r in runs.latest_metrics(log).collect()}
    assert (out["a"].mean_reward, out["a"].tokens_per_sec, out["a"].peak_memory_gb) == (0.5, 10.0, None)
    assert out["a"].elapsed_sec is None  # not in the log at all
    # Log order counts, not the step.
    shuffled = log.withColumn("step", 10 - F.col("step"))
    assert {r.run: r.mean_reward for r in runs.latest_metrics(shuffled).collect()}["a"] == 0.5


def test_log_without_steps(log):
    out = {r.run: r.mean_reward for r in runs.latest_metrics(log.drop("step")).collect()}
    assert out["a"] == 0.9


def test_compare_and_report(log):
    comparison = runs.compare_runs(log, "a", "b")
    assert [tuple(r) for r in comparison.orderBy("position").collect()] == [
        (0, "mean_reward", 0.5, 1e-7),
        (4, "tokens_per_sec", 10.0, None),
    ]
    lines = [r.line for r in runs.report_lines(comparison, "A", "B").orderBy("position").collect()]
    assert lines == [
        "# A vs B Report", "", "## Summary", "", "| Metric | A | B |", "| --- | ---: | ---: |",
        "| mean_reward | 0.5 | 1e-07 |", "| tokens_per_sec | 10.0 | N/A |",
    ]
    assert runs.compare_runs(log.select("run", "ord"), "a", "b").count() == 0


def test_float_text(values):
    numbers = [0.5, 12.0, 1e7, 123456789.25, 1e15, 9007199254740993.0, 1e16, 1.5e300, 1e-4, 0.00012345, 9.9e-5, 1e-7,
               1.25e-10, -2.5e20, 0.0, -0.0, 1 / 3, 100.0, float("inf"), float("-inf"), float("nan")]
    assert values(numbers, runs.float_text(F.col("t")), "id int, t double") == [repr(n) for n in numbers]


def test_curves(log):
    out = {r.step: (r.mean_reward_a, r.mean_reward_b) for r in runs.align_curves(log, "a", "b", ("mean_reward", "absent")).collect()}
    assert out == {1: (0.1, None), 2: (0.5, 0.7), 3: (None, 1e-7)}
    assert runs.curve_points(log, "mean_reward").count() == 6


def test_reward_means(spark):
    df = spark.createDataFrame(
        [("r", 1, 1.0, 1.0, 0.0, 0.5), ("r", 1, 0.0, 0.0, 0.0, 1.0)],
        "run string, step int, combined_reward double, correctness_reward double, rlaif_reward double, format_reward double",
    )
    assert tuple(runs.reward_means(df).first()) == ("r", 1, 0.5, 0.5, 0.0, 0.75)


def test_latency(spark):
    rows = [("x", 1.0, "a b"), ("x", 3.0, "a"), ("x", 2.0, " "), ("x", 6.0, "a　b c"), (None, 0.0, "a"), ("z", 5.0, "")]
    df = spark.createDataFrame(rows, "k string, latency_sec double, text string")
    out = {r.k: tuple(r)[1:] for r in runs.latency_summary(df, by=("k",)).collect()}
    assert out == {"x": (4, 3.0, 2.5, 0.5), None: (1, 0.0, 0.0, 0.0), "z": (1, 5.0, 5.0, 0.0)}
    total = runs.latency_summary(df.where("k = 'x'")).first()
    # Mean words over mean latency, not the mean of the ratios.
    assert tuple(total) == (4, 3.0, 2.5, 1.5 / 3.0)


def test_upsert(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    changes = spark.createDataFrame([("b", 3), ("c", 4)], "name string, v int")
    assert sorted(tuple(r) for r in tables.upsert(current, changes).collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_split(spark):
    df = spark.range(4_000)
    train, held_out = tables.split_train_validation(df, "id", 0.1)
    assert train.count() + held_out.count() == 4_000
    assert train.intersect(held_out).count() == 0
    assert 300 < held_out.count() < 500
    again = tables.split_train_validation(df.where("id < 100").repartition(3), "id", 0.1)[1]
    assert {r.id for r in again.collect()} == {r.id for r in held_out.where("id < 100").collect()}
    assert tables.split_train_validation(df, "id", 0.0)[1].count() == 0
    with pytest.raises(ValueError):
        tables.is_validation("id", 1.5)
