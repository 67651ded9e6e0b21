import os
import shutil

import pytest
from pyspark.sql import functions as F

from gradeloom.operators import pairs, zipping
from gradeloom.operators.zipping import Zipped
from gradeloom.streaming import metrics_log
from gradeloom.streaming import pairs as stream_pairs
from gradeloom.streaming.merge_log import MergeLog

RECORD = "ord long, prompt string, chosen string, answer string, score_chosen double, metadata struct<source: string>"


def part(spark, values, reverse=False):
    df = spark.createDataFrame([(i * 3 % 101, v) for i, v in enumerate(values)], "k long, v string").repartition(3)
    place = F.transform(F.array("k"), lambda k: k * 34 % 101)[0]  # 34 undoes the 3
    return df, "v", [-place if reverse else place]


def test_positions_pair_up(spark):
    zipped = Zipped({"p": part(spark, "abcde"), "r": part(spark, "xyz"), "a": part(spark, "1234", reverse=True)})
    rows = [(r.position, r.p, r.r, r.a) for r in sorted(zipped.rows().collect())]
    assert rows == [(0, "a", "x", "4"), (1, "b", "y", "3"), (2, "c", "z", "2")]
    report = {r.table: (r.rows, r.paired, r.unpaired) for r in zipped.report().collect()}
    assert report == {"p": (5, 3, 2), "r": (3, 3, 0), "a": (4, 3, 1)}
    assert sorted((r.position, r.p) for r in zipped.unpaired("p").collect()) == [(3, "d"), (4, "e")]
    assert zipped.unpaired("r").count() == 0


def test_an_empty_side_leaves_nothing(spark):
    zipped = Zipped({"p": part(spark, "ab"), "r": (spark.createDataFrame([], "k long, v string"), "v", ["k"])})
    assert zipped.rows().count() == 0
    assert {r.table: r.unpaired for r in zipped.report().collect()} == {"p": 2, "r": 0}
    with pytest.raises(ValueError):
        Zipped({"p": part(spark, "ab")})


def test_scores_and_accuracy_by_position(spark):
    prompts, answers = part(spark, ["1+3=?", "1+1=?", "extra"]), part(spark, ["4", "3"])
    responses = part(spark, ["思路：直接相加\n步骤：1+3=4\n答案：4", "答案：2"])
    scored = {r.position: r.correctness_reward for r in zipping.score_zipped(prompts, responses, answers).collect()}
    assert scored == {0: 1.0, 1: 0.0}
    assert zipping.accuracy_zipped(responses, answers).first() == (2, 0.5)
    assert zipping.accuracy_zipped(responses, part(spark, [])).first() == (0, 0.0)


def counts_log(path, every=3):
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    return MergeLog(str(path), lambda df: df.groupBy("k").agg(F.count(F.lit(1)).alias("n")), merge, every)


def state(spark, log):
    return {r.k: r.n for r in log.read(spark).collect()}


def test_batches_count_once(spark, tmp_path):
    log = counts_log(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        log.read(spark)
    expected = {}
    for batch in range(11):
        rows = [("hot",)] * 5 + [(f"k{batch % 4}",)]
        for (k,) in rows:
            expected[k] = expected.get(k, 0) + 1
        df = spark.createDataFrame(rows, "k string")
        log.add(df, batch)
        log.add(df, batch)  # the same batch once more
        assert state(spark, log) == expected, batch
    # One superseded base stays for readers that have begun.
    left = sorted(name for name in os.listdir(tmp_path / "t"))
    assert [n for n in left if n.startswith("base=")] == ["base=000000000005", "base=000000000008"]
    assert [n for n in left if n.startswith("batch=")] == [f"batch={i:012d}" for i in range(6, 11)]
    log.add(spark.createDataFrame([("old",)], "k string"), 2)  # long since in a base
    assert state(spark, log) == expected


def test_a_killed_batch_is_not_read(spark, tmp_path):
    log = counts_log(tmp_path / "t", every=2)
    for batch in range(3):
        log.add(spark.createDataFrame([("a",)], "k string"), batch)
    # Batch 3 dies: once while its rows, once while its base is written.
    shutil.copytree(tmp_path / "t" / "batch=000000000002", tmp_path / "t" / "batch=000000000003")
    os.remove(tmp_path / "t" / "batch=000000000003" / "_SUCCESS")
    assert state(spark, log) == {"a": 3}
    log.add(spark.createDataFrame([("a",)], "k string"), 3)
    assert state(spark, log) == {"a": 4}
    os.remove(tmp_path / "t" / "base=000000000003" / "_SUCCESS")
    assert state(spark, log) == {"a": 4}
    log.add(spark.createDataFrame([("a",)], "k string"), 3)
    assert state(spark, log) == {"a": 4}


def test_stream_pairs_equal_the_batch(spark, tmp_path):
    def record(i, prompt, score):
        return (i, prompt, f"r{i}", "" if i % 2 else f"a{i}", score, (None if i % 3 else "s",))

    batches = [
        [record(1, "p", 1.0), record(2, "p", 1.0), record(3, "q", 0.5)],
        [record(4, "p", 3.0), record(5, "one", 2.0)],
        [record(6, "p", -1.0), record(7, "q", None), record(0, "q", 0.5), record(8, None, 1.0), record(9, None, 1.0)],
    ]
    source, target = str(tmp_path / "in"), str(tmp_path / "ends")
    for batch in batches:
        spark.createDataFrame(batch, RECORD).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(RECORD).parquet(source)
        stream_pairs.follow_pairs(arriving, target, str(tmp_path / "progress"), every=2, once=True).awaitTermination()
        whole = pairs.pairs_from_scores(spark.read.parquet(source))
        assert sorted(map(str, stream_pairs.read_pairs(spark, target).collect())) == sorted(map(str, whole.collect()))
    # The last batch once more, as after a failure before its progress was noted.
    stream_pairs.ends_log(target, every=2).add(spark.createDataFrame(batches[-1], RECORD), 2)
    assert sorted(map(str, stream_pairs.read_pairs(spark, target).collect())) == sorted(map(str, whole.collect()))


def test_latest_metrics_write_changed_runs_only(spark, tmp_path):
    path, target = str(tmp_path / "log"), tmp_path / "latest"

    def add(rows):
        metrics_log.append_metrics(spark.createDataFrame(rows, "run string, ord long, step long, mean_reward double"), path)
        metrics_log.follow_latest(metrics_log.stream_metrics(spark, path), str(target), str(tmp_path / "progress"), once=True).awaitTermination()

    add([(f"run{i}", 1, 1, i / 1000) for i in range(1000)])
    add([("run7", 2, 2, 0.5), ("run8", 2, None, 0.9), ("run9", 2, 2, None)])
    first, second = (spark.read.parquet(str(target / f"batch={i:012d}")).count() for i in (0, 1))
    assert (first, second) == (1000, 2)
    latest = {r.run: r.mean_reward for r in metrics_log.read_latest(spark, str(target)).collect()}
    assert len(latest) == 1000 and latest["run7"] == 0.5 and latest["run8"] == 0.008 and latest["run9"] == 0.009
