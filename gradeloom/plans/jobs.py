"""Whole jobs: prepare and export training tables, evaluate, compare runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import schemas
from gradeloom.fixed import CURVE_METRICS, SUMMARY_METRICS, TRAINING_SYSTEM_PROMPT
from gradeloom.functions.prompts import rl_prompt
from gradeloom.operators import evaluation, exports, runs
from gradeloom.operators.limits import prefix_limit
from gradeloom.operators.normalize import normalize_rl, normalize_sft
from gradeloom.operators.pairs import Mode, convert_rewards
from gradeloom.operators.scoring import generate_completions
from gradeloom.sources.datasets import load_dataset
from gradeloom.sources.jsonl import reuse_or_build, write_jsonl, write_ordered_jsonl
from gradeloom.sources.reports import (
    register_datasets,
    registry_entries,
    write_csv,
    write_report,
    write_summary,
)


@dataclass(frozen=True)
class DataConfig:
    """Where a stage reads from and writes to."""

    name: str
    train_split: str
    train_path: str
    eval_path: str
    # The train split when none is named.
    eval_split: str | None = None
    config: str | None = None
    schema: T.StructType | str | None = None
    max_train: int | None = None
    max_eval: int | None = None
    reuse: bool = True
    ord_col: str = "ord"


Convert = Callable[[DataFrame, str, int | None], DataFrame]


def _prepare(
    spark: SparkSession, data: DataConfig, convert: Convert, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    def build(split: str, limit: int | None) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            raw = load_dataset(spark, data.name, split, data.config, data.schema, data.ord_col)
            return convert(raw, data.name, limit)

        return run

    builders = {
        data.train_path: build(data.train_split, data.max_train),
        data.eval_path: build(data.eval_split or data.train_split, data.max_eval),
    }
    tables = reuse_or_build(spark, builders, schema, data.reuse)
    return tables[data.train_path], tables[data.eval_path]


def prepare_sft(spark: SparkSession, data: DataConfig) -> tuple[DataFrame, DataFrame]:
    """Unified train and evaluation tables, written and read back."""
    schema = schemas.with_ordinal_field(schemas.UNIFIED, data.ord_col)
    return _prepare(
        spark, data, lambda df, source, limit: normalize_sft(df, source, limit, data.ord_col), schema
    )


def prepare_rl(spark: SparkSession, data: DataConfig) -> tuple[DataFrame, DataFrame]:
    """Prompt-only train and evaluation tables, written and read back."""
    schema = schemas.with_ordinal_field(schemas.RL_PROMPT, data.ord_col)
    return _prepare(
        spark, data, lambda df, source, limit: normalize_rl(df, source, limit, data.ord_col), schema
    )


def prepare_rewards(
    spark: SparkSession, data: DataConfig, mode: Mode = "auto"
) -> tuple[DataFrame, DataFrame]:
    """Train and evaluation pairs, written and read back."""
    schema = schemas.with_ordinal_field(schemas.REWARD, "first_ord")
    return _prepare(
        spark, data, lambda df, source, limit: convert_rewards(df, source, limit, mode, data.ord_col), schema
    )


def _export(
    spark: SparkSession,
    folder: str,
    stage: str,
    tables: tuple[DataFrame, DataFrame],
    file_stem: str,
    layout: dict,
    order: str,
) -> str:
    files = {}
    for side, table in zip(("train", "eval"), tables):
        file = f"{file_stem}_{side}.jsonl"
        write_ordered_jsonl(table, f"{folder}/{file}", [order], drop=[order])
        files[f"{stage}_{side}"] = file
    return register_datasets(spark, f"{folder}/dataset_info", registry_entries(spark, files, layout))


def export_sft(
    spark: SparkSession, data: DataConfig, folder: str, stage: str = "sft", system_prompt: str | None = None
) -> str:
    """Chat tables and their registry entries from raw data."""
    train, held_out = prepare_sft(spark, data)
    prompt = system_prompt or TRAINING_SYSTEM_PROMPT
    tables = (exports.chat_table(train, prompt, data.ord_col), exports.chat_table(held_out, prompt, data.ord_col))
    return _export(spark, folder, stage, tables, "sft", exports.CHAT_LAYOUT, data.ord_col)


def export_rewards(
    spark: SparkSession, data: DataConfig, folder: str, stage: str = "reward", mode: Mode = "auto"
) -> str:
    """Preference tables and their registry entries from raw data."""
    train, held_out = prepare_rewards(spark, data, mode)
    tables = (exports.preference_table(train, "first_ord"), exports.preference_table(held_out, "first_ord"))
    return _export(spark, folder, stage, tables, "reward", exports.PREFERENCE_LAYOUT, "first_ord")


def export_instructions(
    spark: SparkSession, data: DataConfig, folder: str, stage: str = "ppo"
) -> str:
    """Instruction tables and their registry entries from raw data."""
    train, held_out = prepare_rl(spark, data)
    tables = (exports.instruction_table(train, data.ord_col), exports.instruction_table(held_out, data.ord_col))
    return _export(spark, folder, stage, tables, "ppo", exports.INSTRUCTION_LAYOUT, data.ord_col)


def evaluate_model(
    spark: SparkSession,
    dataset: str,
    split: str,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    output: str,
    config: str | None = None,
    schema: T.StructType | str | None = None,
    question: str = "question",
    answer: str = "answer",
    max_samples: int | None = None,
    ord_col: str = "ord",
) -> DataFrame:
    """Answer a dataset with the user's model and write rows and summary.

    All rows are read unless ``max_samples`` says otherwise.
    Rows are written before they are summarised, so the model runs once. Returns the
    one-row summary.
    """
    raw = prefix_limit(load_dataset(spark, dataset, split, config, schema, ord_col), max_samples, ord_col)
    text = F.coalesce(F.col(question), F.lit("")) if question in raw.columns else F.lit("")
    asked = raw.withColumn("__prompt", rl_prompt(text))
    rows = evaluation.eval_rows(
        generate_completions(asked, factory, "__prompt", "prediction"), question, answer, "prediction"
    )
    write_jsonl(rows, output)
    written = spark.read.schema(schemas.EVAL_ROW).json(output).withColumns(
        {"dataset": F.lit(dataset), "split": F.lit(split)}
    )
    summary = evaluation.eval_summary(written, by=("dataset", "split"))
    write_summary(summary, f"{output.rstrip('/')}.summary.json")
    return summary


def compare_and_report(
    log: DataFrame, run_a: str, run_b: str, folder: str, title: str | None = None
) -> DataFrame:
    """Write both runs' logs as CSV, their aligned curves and the Markdown report.

    The curves are one CSV table with a row per step of either run, for the curve
    metrics that the log has.
    """
    steps = runs.logged_steps(log)
    write_csv(runs.align_curves(log, run_a, run_b, CURVE_METRICS), f"{folder}/curves.csv")
    for name in (run_a, run_b):
        write_csv(steps.where(F.col("run") == name), f"{folder}/{name}_metrics.csv")
    comparison = runs.compare_runs(log, run_a, run_b, SUMMARY_METRICS)
    write_report(runs.report_lines(comparison, run_a, run_b, title), f"{folder}/report.md")
    return comparison
