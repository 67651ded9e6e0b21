"""Metrics logs: latest values, run comparison, curves, rates and group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.fixed import SUMMARY_METRICS
from gradeloom.functions.numbers import float_text
from gradeloom.functions.whitespace import word_count
from gradeloom.operators.ordered import same_keys, with_group_values, with_last_known
from gradeloom.operators.selection import median_of_counts
from gradeloom.runtime import stored

_ALL = "__all"
_COMPARISON = "position int, metric string, run_a double, run_b double"


def logged_steps(log: DataFrame) -> DataFrame:
    """Rows that belong to a step, when the log has steps at all."""
    return log.where(F.col("step").isNotNull()) if "step" in log.columns else log


def _present(log: DataFrame, metrics: Sequence[str]) -> list[str]:
    return [name for name in metrics if name in log.columns]


def _last_logged(metric: str, ord_col: str) -> Column:
    """Value of the last row, in log order, that has the metric."""
    logged = F.col(metric).isNotNull()
    return F.max_by(F.col(metric).cast("double"), F.when(logged, F.col(ord_col)))


def latest_metrics(
    log: DataFrame,
    metrics: Sequence[str] = SUMMARY_METRICS,
    run: str = "run",
    ord_col: str = "ord",
) -> DataFrame:
    """One row per run with the last logged value of every metric.

    A metric the log lacks is null. One aggregate over fixed-size state, so a run of
    any length is reduced before the shuffle.
    """
    present = _present(log, metrics)
    values = [_last_logged(name, ord_col).alias(name) for name in present]
    reduced = logged_steps(log).groupBy(run).agg(F.count(F.lit(1)).alias("rows"), *values)
    missing = {name: F.lit(None).cast("double") for name in metrics if name not in present}
    return reduced.withColumns(missing).select(run, *metrics) if missing else reduced.select(run, *metrics)


def last_known_metrics(
    log: DataFrame,
    metrics: Sequence[str] = SUMMARY_METRICS,
    run: str = "run",
    ord_col: str = "ord",
) -> DataFrame:
    """The log with the last known value of each metric carried to every row."""
    return with_last_known(
        logged_steps(log), [run], [F.col(ord_col)], _present(log, metrics)
    )


def compare_runs(
    log: DataFrame,
    run_a: str,
    run_b: str,
    metrics: Sequence[str] = SUMMARY_METRICS,
    run: str = "run",
    ord_col: str = "ord",
) -> DataFrame:
    """One row per metric with the latest value of two runs.

    Metrics neither run has logged are left out. ``position`` is the report order.
    """
    steps = logged_steps(log)
    present = _present(log, metrics)

    def value(name: str, wanted: str) -> Column:
        mine = (F.col(run) == wanted) & F.col(name).isNotNull()
        return F.max_by(F.col(name).cast("double"), F.when(mine, F.col(ord_col)))

    if not present:
        return log.sparkSession.createDataFrame([], _COMPARISON)
    reduced = steps.where(F.col(run).isin(run_a, run_b)).agg(
        *[
            F.struct(
                F.lit(metrics.index(name)).alias("position"),
                F.lit(name).alias("metric"),
                value(name, run_a).alias("run_a"),
                value(name, run_b).alias("run_b"),
            ).alias(name)
            for name in present
        ]
    )
    lines = reduced.select(F.inline(F.array(*[F.col(name) for name in present])))
    return lines.where(F.col("run_a").isNotNull() | F.col("run_b").isNotNull())


def curve_points(log: DataFrame, metric: str, run: str = "run", ord_col: str = "ord") -> DataFrame:
    """Every point of a metric's curves as ``run, step, ord, value``."""
    return log.where(F.col("step").isNotNull()).select(
        F.col(run).alias("run"),
        "step",
        F.col(ord_col).alias("ord"),
        F.col(metric).cast("double").alias("value"),
    )


def align_curves(
    log: DataFrame,
    run_a: str,
    run_b: str,
    metrics: Sequence[str],
    run: str = "run",
    ord_col: str = "ord",
) -> DataFrame:
    """Both runs' curves side by side, one row per step of either run.

    A step logged more than once shows its last value. Both runs are reduced in one
    aggregate on the step, which is a full outer join without pairing up repeated
    steps. Metrics missing from the log are left out.
    """

    def value(name: str, wanted: str) -> Column:
        mine = (F.col(run) == wanted) & F.col(name).isNotNull()
        return F.max_by(F.col(name).cast("double"), F.when(mine, F.col(ord_col)))

    columns = [
        value(name, wanted).alias(f"{name}_{side}")
        for name in _present(log, metrics)
        for side, wanted in (("a", run_a), ("b", run_b))
    ]
    both = log.where(F.col("step").isNotNull() & F.col(run).isin(run_a, run_b))
    return both.groupBy("step").agg(*columns)


def report_lines(
    comparison: DataFrame, run_a: str, run_b: str, title: str | None = None
) -> DataFrame:
    """Markdown table of a run comparison as ``position, line``."""
    heading = [
        f"# {title or f'{run_a} vs {run_b} Report'}",
        "",
        "## Summary",
        "",
        f"| Metric | {run_a} | {run_b} |",
        "| --- | ---: | ---: |",
    ]

    def cell(name: str) -> Column:
        return F.coalesce(float_text(F.col(name)), F.lit("N/A"))

    body = comparison.select(
        (F.col("position") + len(heading)).alias("position"),
        F.concat(
            F.lit("| "), F.col("metric"), F.lit(" | "), cell("run_a"), F.lit(" | "), cell("run_b"), F.lit(" |")
        ).alias("line"),
    )
    head = comparison.sparkSession.createDataFrame(
        list(enumerate(heading)),
        T.StructType([T.StructField("position", T.IntegerType()), T.StructField("line", T.StringType())]),
    )
    return head.unionByName(body)


def reward_means(
    scored: DataFrame, by: Sequence[str] = ("run", "step")
) -> DataFrame:
    """Mean of the combined reward and its parts per run and step."""
    return scored.groupBy(*by).agg(
        F.avg("combined_reward").alias("mean_reward"),
        F.avg("correctness_reward").alias("mean_correctness_reward"),
        F.avg("rlaif_reward").alias("mean_rlaif_reward"),
        F.avg("format_reward").alias("mean_format_reward"),
    )


def group_advantage(
    scored: DataFrame,
    group: str = "prompt",
    reward: str = "combined_reward",
    epsilon: float = 1e-4,
) -> DataFrame:
    """Add each completion's reward relative to its group.

    ``(reward - mean) / (population deviation + epsilon)`` over the completions of a
    prompt. A prompt with very many completions is never gathered in one task, and what the
    rewards are computed from is evaluated once.
    """
    scored = stored(scored, "scored")
    values = {"group_mean": F.avg(reward), "group_std": F.stddev_pop(reward)}
    placed = with_group_values(scored, [group], values)
    advantage = (F.col(reward) - F.col("group_mean")) / (F.col("group_std") + F.lit(epsilon))
    return placed.withColumn("advantage", advantage)


def latency_summary(
    requests: DataFrame,
    by: Sequence[str] = (),
    latency: str = "latency_sec",
    text: str = "text",
) -> DataFrame:
    """Request count, mean and median latency and words per second.

    The rate is mean words over mean latency, 0.0 when the latter is zero. The
    median is exact and is found without gathering a group in one task.
    """
    keys = list(by) or [_ALL]
    words = requests.select(
        *(by or [F.lit(0).alias(_ALL)]), F.col(latency).alias("__latency"), word_count(text).alias("__words")
    )
    # Everything follows from the requests and words per distinct latency: -0.0 is 0.0.
    words = words.withColumn("__latency", F.col("__latency").cast("double") + F.lit(0.0))
    n, known = F.col("__n"), F.col("__latency").isNotNull()
    counted = words.groupBy(*keys, "__latency").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__words").alias("__sum"), F.count("__words").alias("__texts")
    )
    # Read several times from here on.
    counted = stored(counted, "latencies")
    means = counted.groupBy(*keys).agg(
        F.sum(n).alias("repeats"),
        (F.sum(F.col("__latency") * n) / F.sum(F.when(known, n))).alias("avg_latency_sec"),
        F.try_divide(F.sum("__sum"), F.sum("__texts")).alias("__avg_words"),
    )
    medians = median_of_counts(counted, keys, "__latency", "__n", "p50_latency_sec")
    merged = same_keys(means, medians, keys)
    average = F.col("avg_latency_sec")
    return merged.select(
        *by,
        "repeats",
        "avg_latency_sec",
        "p50_latency_sec",
        F.when(average != 0, F.col("__avg_words") / average).otherwise(F.lit(0.0)).alias("approx_tokens_per_sec"),
    )
