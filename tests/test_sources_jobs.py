"""Files, registry, streams and whole jobs."""

import json
import os
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gradeloom import fixed, schemas
from gradeloom.operators import exports, normalize, scoring
from gradeloom.plans import jobs
from gradeloom.sources import datasets, jsonl, reports
from gradeloom.streaming import metrics_log
from gradeloom.streaming import scoring as stream_scoring


def lines_in(folder):
    return [line for part in sorted(Path(folder).glob("part-*")) for line in part.read_text("utf-8").splitlines()]


def test_jsonl_round_trip(spark, tmp_path):
    df = datasets.from_records(spark, [{"a": "答\n\r ", "b": None}, {"a": "", "b": 2}], "a string, b int", "ord")
    path = jsonl.write_jsonl(df, str(tmp_path / "t"))
    text = "\n".join(lines_in(path))
    assert "答" in text and '"b":null' in text
    back = jsonl.read_jsonl(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == [("答\n\r ", None, 0), ("", 2, 1)]
    jsonl.write_jsonl(df.limit(1), path)
    assert jsonl.read_jsonl(spark, path, df.schema, strict=False).count() == 1
    jsonl.append_jsonl(df, path)
    assert jsonl.read_jsonl(spark, path, df.schema).count() == 3


def test_strict_jsonl(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"a": "x"}\n\n 　\n  {"a": "y"}\n', "utf-8")
    assert jsonl.read_jsonl(spark, str(good), "a string").count() == 2
    for number, line in enumerate(
        ['[{"a": "x"}]', '{"a": ', '"text"', "7", '{"a": "x"} y', '{"a": "x"}{"a": "y"}', '{"a": "x"}, {"a": "y"}']
    ):
        bad = tmp_path / f"bad{number}.jsonl"
        bad.write_text('{"a": "x"}\n\n' + line + "\n", "utf-8")
        with pytest.raises(Exception, match="(?i)not a JSON object|malformed"):
            jsonl.read_jsonl(spark, str(bad), "a string").collect()
        with pytest.raises(Exception, match="(?i)not a JSON object|malformed"):
            jsonl.read_ragged_jsonl(spark, str(bad), ("a",)).collect()
        found = jsonl.invalid_jsonl_lines(spark, str(bad)).collect()
        assert [(r.line_number, r.line) for r in found] == [(3, line)]
    assert jsonl.invalid_jsonl_lines(spark, str(good)).count() == 0


def test_line_numbers_across_blocks(spark, tmp_path):
    path = tmp_path / "long.jsonl"
    rows = [f'{{"a": {i}}}' if i % 997 else f"broken {i}" for i in range(1, 20_001)]
    path.write_text("\n".join(rows) + "\n", "utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = jsonl.invalid_jsonl_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.line_number, r.line) for r in found) == [(i, f"broken {i}") for i in range(997, 20_001, 997)]


def test_ragged_jsonl(spark, tmp_path):
    path = tmp_path / "ragged.jsonl"
    path.write_text('{"question": 5, "problem": "p", "id": 1}\n{"prompt": "q", "answer": null, "id": 2}\n', "utf-8")
    df = jsonl.read_ragged_jsonl(spark, str(path), ("question", "problem", "prompt", "answer"), ("id",))
    out = {r.prompt.rsplit("：", 1)[1]: r.metadata.raw_keys for r in normalize.normalize_rl(df, "x").collect()}
    assert out == {"p": ["id", "problem", "question"], "q": ["answer", "id", "prompt"]}


def test_load_if_complete(spark, tmp_path):
    assert jsonl.load_if_complete(spark, None, "a int") is None
    assert jsonl.load_if_complete(spark, str(tmp_path / "none"), "a int") is None
    unfinished = tmp_path / "unfinished"
    unfinished.mkdir()
    (unfinished / "part-0.json").write_text('{"a": 1}\n')
    assert jsonl.load_if_complete(spark, str(unfinished), "a int") is None
    (unfinished / "_SUCCESS").write_text("")
    assert jsonl.load_if_complete(spark, str(unfinished), "a int").count() == 1
    single = tmp_path / "one.jsonl"
    single.write_text('{"a": 1}\n')
    assert jsonl.load_if_complete(spark, str(single), "a int").first().a == 1


def test_reuse_or_build(spark, tmp_path):
    built = []

    def build(n):
        built.append(n)
        return spark.range(n).withColumnRenamed("id", "a")

    builders = {str(tmp_path / "x"): lambda: build(2), str(tmp_path / "y"): lambda: build(3)}
    for reuse, expected in ((True, [2, 3]), (True, [2, 3]), (False, [2, 3, 2, 3])):
        out = jsonl.reuse_or_build(spark, builders, "a long", reuse)
        assert built == expected and [df.count() for df in out.values()] == [2, 3]


def test_dataset_splits(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "ord").write.parquet(str(tmp_path / "main" / "train"))
    sliced = datasets.load_dataset(spark, str(tmp_path), "train[2:4]", "main")
    assert sorted(r.ord for r in sliced.collect()) == [2, 3]
    parts = spark.range(10).select(F.col("id").alias("ord"), F.when(F.col("id") < 6, "train").otherwise("test").alias("split"))
    parts.write.partitionBy("split").parquet(str(tmp_path / "parts"))
    held_out = datasets.load_dataset(spark, str(tmp_path / "parts"), "test[:2]")
    assert sorted(r.ord for r in held_out.collect()) == [6, 7]
    parts.createOrReplaceTempView("named")
    assert datasets.load_dataset(spark, "named", "train").count() == 6


def test_a_table_without_split_column_is_refused(spark):
    spark.range(3).createOrReplaceTempView("unsplit")
    with pytest.raises(ValueError):
        datasets.load_dataset(spark, "unsplit", "train")


def test_scratch_paths_lie_in_the_shared_folder(spark):
    from gradeloom.runtime import scratch_path, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(path.startswith(shared_dir(spark) + "/x-") for path in paths)


def test_calibration_prompts(spark, tmp_path):
    schema = schemas.with_ordinal_field(schemas.RL_PROMPT)
    standing = datasets.calibration_prompts(spark, str(tmp_path / "none"), 8, schema)
    assert tuple(r.prompt for r in standing.collect()) == fixed.FALLBACK_CALIBRATION_PROMPTS
    df = spark.createDataFrame([(f"p{i}", "", ("s", []), 9 - i) for i in range(5)], schema)
    path = jsonl.write_jsonl(df, str(tmp_path / "sft"))
    assert sorted(r.prompt for r in datasets.calibration_prompts(spark, path, 2, schema).collect()) == ["p3", "p4"]


def test_exports(spark, tmp_path):
    unified = spark.createDataFrame(
        [("求 1+1", "答案：2", "2", ("unit", ["a"]))], "prompt string, response string, answer string, metadata struct<source:string,raw_keys:array<string>>"
    )
    chat = exports.chat_table(unified, "你是数学老师。")
    row = json.loads(lines_in(jsonl.write_jsonl(chat, str(tmp_path / "sft")))[0])
    assert [m["role"] for m in row["messages"]] == ["system", "user", "assistant"]
    assert row["answer"] == "2" and row["metadata"]["source"] == "unit"
    bare = spark.createDataFrame([("1+1=?", "答案：2", "答案：3", 1.0)], "prompt string, chosen string, rejected string, score_chosen double")
    row = json.loads(lines_in(jsonl.write_jsonl(exports.preference_table(bare), str(tmp_path / "reward")))[0])
    assert row == {"prompt": "1+1=?", "chosen": "答案：2", "rejected": "答案：3", "answer": "", "metadata": {}}
    row = json.loads(lines_in(jsonl.write_jsonl(exports.instruction_table(bare.select("prompt")), str(tmp_path / "ppo")))[0])
    assert row == {"instruction": "1+1=?", "input": "", "output": "", "answer": "", "metadata": {}}
    assert exports.chat_table(bare.select("prompt")).first().messages[2].content == ""
    with pytest.raises(ValueError):
        exports.preference_table(bare.drop("rejected"))


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert reports.read_registry(spark, path).count() == 0
    for files, layout in (
        ({"sft_train": "sft.jsonl"}, exports.CHAT_LAYOUT),
        ({"reward_train": "reward.jsonl"}, exports.PREFERENCE_LAYOUT),
        ({"sft_train": "new.jsonl"}, exports.CHAT_LAYOUT),
    ):
        reports.register_datasets(spark, path, reports.registry_entries(spark, files, layout))
    out = {r.name: r for r in reports.read_registry(spark, path).collect()}
    assert sorted(out) == ["reward_train", "sft_train"]
    assert out["sft_train"].file_name == "new.jsonl" and out["sft_train"].columns == {"messages": "messages"}
    assert out["reward_train"].ranking is True


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (0, "a")], "position int, line string").repartition(2)
    assert lines_in(reports.write_report(df, str(tmp_path / "report"))) == ["a", "b"]
    assert lines_in(reports.write_csv(df.coalesce(1).orderBy("position"), str(tmp_path / "csv"))) == ["position,line", "0,a", "1,b"]
    assert json.loads(lines_in(reports.write_summary(df.limit(1), str(tmp_path / "sum")))[0]).keys() == {"position", "line"}


def test_score_stream(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    df = spark.createDataFrame([("p", "答案：4", "4"), ("p", "答案：5", "4")], "prompt string, response string, answer string")
    for _ in range(2):
        df.write.mode("append").parquet(str(source))
        arriving = datasets.stream_dataset(spark, str(source), df.schema)
        stream_scoring.score_stream(arriving, target, str(tmp_path / "progress"), once=True).awaitTermination()
    out = spark.read.parquet(target)
    assert out.count() == 4 and out.where("correctness_reward = 1.0").count() == 2


def test_normalise_stream(spark, tmp_path):
    df = spark.createDataFrame([("求 2+2", "4")], "question string, answer string")
    df.write.parquet(str(tmp_path / "in"))
    arriving = datasets.stream_dataset(spark, str(tmp_path / "in"), df.schema)
    stream_scoring.append_stream(
        arriving, lambda rows: normalize.normalize_rl(rows, "s"), str(tmp_path / "out"), str(tmp_path / "p"), once=True
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().prompt.endswith("求 2+2")


def test_metrics_log(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "latest")

    def add(*rows):
        metrics_log.append_metrics(spark.createDataFrame(rows, "run string, ord long, step long, mean_reward double"), path)

    def follow():
        metrics_log.follow_latest(
            metrics_log.stream_metrics(spark, path), target, str(tmp_path / "progress"), once=True
        ).awaitTermination()
        return {r.run: r.mean_reward for r in metrics_log.read_latest(spark, target).collect()}

    add(("a", 1, 1, 0.1), ("a", 2, 1, None))
    assert follow() == {"a": 0.1}
    add(("a", 3, 2, 0.3), ("b", 1, 1, 0.9))
    assert follow() == {"a": 0.3, "b": 0.9}
    assert metrics_log.read_metrics(spark, path).count() == 4
    with pytest.raises(ValueError):
        metrics_log.append_metrics(spark.range(1), path)


@pytest.fixture
def raw(spark, tmp_path):
    rows = [(i, f"q{i}", f"step\n答案：{i}", f"good {i}", f"bad {i}") for i in range(12)]
    df = spark.createDataFrame(rows, "ord long, question string, solution string, chosen string, rejected string")
    df.write.parquet(str(tmp_path / "raw" / "train"))
    return jobs.DataConfig(
        name=str(tmp_path / "raw"), train_split="train", eval_split="train[:5]",
        train_path=str(tmp_path / "p" / "train"), eval_path=str(tmp_path / "p" / "eval"), max_train=10, max_eval=3,
    )


@pytest.mark.parametrize("export, column", [
    (jobs.export_sft, "messages"), (jobs.export_rewards, "chosen"), (jobs.export_instructions, "instruction")
])
def test_export_jobs(spark, tmp_path, raw, export, column):
    folder = str(tmp_path / "export")
    for _ in range(2):
        export(spark, raw, folder, "stage")
    entries = {r.name: r.file_name for r in reports.read_registry(spark, f"{folder}/dataset_info").collect()}
    assert sorted(entries) == ["stage_eval", "stage_train"]
    train = [json.loads(line) for line in lines_in(f"{folder}/{entries['stage_train']}")]
    assert len(train) == 10 and column in train[0]
    assert len(lines_in(f"{folder}/{entries['stage_eval']}")) == 3


def test_evaluate_job(spark, tmp_path, raw):
    def factory():
        return lambda texts: ["思路：x\n步骤：y\n答案：" + text[-1] for text in texts]

    out = str(tmp_path / "eval")
    summary = jobs.evaluate_model(spark, raw.name, "train", factory, out, answer="ord_text", max_samples=7).first()
    assert (summary.samples, summary.format_pass_rate, summary.final_answer_accuracy) == (7, 1.0, 0.0)
    assert json.loads(lines_in(f"{out}.summary.json")[0])["samples"] == 7
    assert len(lines_in(out)) == 7


def test_compare_job(spark, tmp_path):
    log = spark.createDataFrame(
        [("ppo", 1, 1, 0.25), ("grpo", 1, 1, 0.75), ("grpo", 2, None, 9.0)], "run string, ord long, step long, mean_reward double"
    )
    jobs.compare_and_report(log, "ppo", "grpo", str(tmp_path / "r"))
    assert lines_in(tmp_path / "r" / "report.md")[-1] == "| mean_reward | 0.25 | 0.75 |"
    curves = spark.read.csv(str(tmp_path / "r" / "curves.csv"), header=True).collect()
    assert [(r.step, r.mean_reward_a, r.mean_reward_b) for r in curves] == [("1", "0.25", "0.75")]
    rows = spark.read.csv(str(tmp_path / "r" / "grpo_metrics.csv"), header=True).collect()
    assert [r.mean_reward for r in rows] == ["0.75"]


def test_registered_queries_have_sql():
    from __spark_entry__ import oracle_sql, queries
    from gradeloom.plans.catalog import QUERIES

    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_scoring_needs_no_python(spark):
    df = spark.createDataFrame([("p", "r", "a")], "prompt string, response string, answer string")
    plan = scoring.score_completions(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_ordered_files_hold_the_order(spark, tmp_path):
    df = spark.createDataFrame([(i * 7 % 1000, f"t{i * 7 % 1000}") for i in range(1000)], "ord long, t string").repartition(5)
    path = jsonl.write_ordered_jsonl(df, str(tmp_path / "o"), ["ord"], drop=["ord"])
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    texts = [json.loads(line)["t"] for n in names for line in open(f"{path}/{n}", encoding="utf-8")]
    assert texts == [f"t{i}" for i in range(1000)]
    rows = jsonl.numbered_lines(spark, path).collect()
    assert [json.loads(r.value)["t"] for r in sorted(rows)] == texts and sorted(r.ord for r in rows) == list(range(1000))
    many = df.repartitionByRange(9, "ord")  # files of many tasks
    assert many.rdd.getNumPartitions() == 9
    down = jsonl.write_ordered_jsonl(df, str(tmp_path / "d"), [df["ord"].desc()])
    assert [json.loads(r.value)["ord"] for r in sorted(jsonl.numbered_lines(spark, down).collect())] == list(range(999, -1, -1))


def test_registry_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """A second writer commits while the first is writing: the first takes its entries in."""
    path = str(tmp_path / "registry")
    enter = lambda name: reports.registry_entries(spark, {name: f"{name}.jsonl"}, exports.CHAT_LAYOUT)
    reports.register_datasets(spark, path, enter("first"))
    real, others = reports.create_once, ["b", "c"]

    def late(session, at, text):
        if others:
            name = others.pop()
            monkeypatch.setattr(reports, "create_once", real)
            reports.register_datasets(session, path, enter(name))
            monkeypatch.setattr(reports, "create_once", late)
        return real(session, at, text)

    monkeypatch.setattr(reports, "create_once", late)
    reports.register_datasets(spark, path, enter("a"))
    assert sorted(r.name for r in reports.read_registry(spark, path).collect()) == ["a", "b", "c", "first"]
    # Versions that lost are gone: one per commit is left.
    assert len([n for n in os.listdir(path) if n.startswith("version=")]) == len([n for n in os.listdir(f"{path}/commits") if n.isdigit()]) == 4


def test_registry_threads(spark, tmp_path):
    path = str(tmp_path / "registry")

    def write(i):
        reports.register_datasets(spark, path, reports.registry_entries(spark, {f"n{i}": "f", "shared": f"{i}"}, exports.CHAT_LAYOUT))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(6)))
    names = sorted(r.name for r in reports.read_registry(spark, path).collect())
    assert names == sorted([*(f"n{i}" for i in range(6)), "shared"])


def test_unfinished_commit_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    reports.register_datasets(spark, path, reports.registry_entries(spark, {"a": "f"}, exports.CHAT_LAYOUT))
    monkeypatch.setattr(reports, "_PATIENCE", 2)
    open(f"{path}/commits/00000002", "w").close()
    with pytest.raises(RuntimeError, match="never finished"):
        reports.read_registry(spark, path)
