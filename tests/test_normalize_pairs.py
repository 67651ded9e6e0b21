"""Normalising raw tables and building pairs."""

import pytest
from pyspark.sql import functions as F

from gradeloom import schemas
from gradeloom.operators import normalize, pairs


def records(spark, rows, schema="ord long, prompt string, chosen string, rejected string, answer string, score_chosen double, source string"):
    df = spark.createDataFrame(rows, schema)
    metadata = F.struct("source", F.lit(None).cast("array<string>").alias("raw_keys"))
    return df.withColumns({"metadata": metadata, "score_rejected": F.lit(None).cast("double")}).drop("source")


def test_sft(spark):
    df = spark.createDataFrame(
        [("求 1+1", "步骤：1+1=2\n答案：2", "2")], "question string, solution string, answer string"
    )
    out = normalize.normalize_sft(df, "unit")
    row = out.first()
    assert (row.prompt, row.answer) == ("求 1+1", "2")
    assert "答案" in row.response
    assert row.metadata.source == "unit" and row.metadata.raw_keys == ["answer", "question", "solution"]
    assert [f.dataType for f in out.schema.fields[:3]] == [f.dataType for f in schemas.UNIFIED.fields[:3]]


def test_sft_candidates_and_fallbacks(spark):
    rows = [
        (0, " \u3000", "p2", 7, None, "\\boxed{3}", None),
        (1, "p1", "p2", 7, "", " ", " t "),
        (2, None, None, 7, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "ord long, prompt string, query string, answer int, solution string, cot string, target string"
    )
    out = {r.ord: r for r in normalize.normalize_sft(df, "x").collect()}
    # A number is not text, so the answer column is passed over.
    assert (out[0].prompt, out[0].answer) == ("p2", "3")
    assert (out[1].prompt, out[1].answer) == ("p1", "t")
    assert "步骤：\nt\n" in out[1].response  # no solution: the answer stands in
    assert (out[2].prompt, out[2].answer) == ("", "") and "待求" in out[2].response
    assert out[0].metadata.raw_keys == ["answer", "cot", "prompt", "query", "solution", "target"]


def test_limit_counts_raw_rows_in_input_order(spark):
    df = spark.createDataFrame([(9, "c"), (2, " "), (5, "b"), (11, "d")], "ord long, question string")
    out = normalize.normalize_rl(df, "x", limit=2).collect()
    assert sorted(r.ord for r in out) == [2, 5]
    assert normalize.normalize_rl(df, "x", limit=0).count() == 0
    assert normalize.normalize_rl(df, "x", limit=9).count() == 4


def test_rl(spark):
    df = spark.createDataFrame([("求 2+2", "4"), (None, None)], "question string, answer string")
    rows = normalize.normalize_rl(df, "unit").collect()
    assert any("题目：求 2+2" in r.prompt and r.answer == "4" for r in rows)
    assert any(r.prompt.endswith("题目：") and r.answer == "" for r in rows)


def test_reward_pair(spark):
    df = spark.createDataFrame(
        [("1+1=?", " 答案：2", "答案：3 ", 0.5)], "prompt string, chosen string, rejected string, score double"
    )
    row = normalize.normalize_rewards(df, "unit").first()
    assert (row.chosen, row.rejected) == ("答案：2", "答案：3")
    assert row.score_chosen is None and row.score_rejected is None


ITEM = "struct<response:string, text:string, score:string, rating:double>"


def test_reward_completions(spark):
    rows = [
        (0, "p", [("a", None, "1", None), (" ", " b ", "3", None), ("c", None, "3", 9.0), ("d", None, "1", None)]),
        (1, "p", [("a", None, None, None), ("b", None, None, -1.0)]),
        (2, "p", [("a", None, "1", None)]),
        (3, "p", [("a", None, "1", None), (" ", None, "1", None)]),
        (4, "p", [None, ("a", None, "5", None), ("b", None, "2", None)]),
        (5, "p", None),
        (6, "", [("a", None, "1", None), ("b", None, "1", None), ("c", None, "1", None)]),
    ]
    df = spark.createDataFrame(rows, f"ord long, prompt string, completions array<{ITEM}>")
    out = {r.ord: (r.chosen, r.rejected, r.score_chosen, r.score_rejected) for r in normalize.normalize_rewards(df, "x").collect()}
    assert out == {
        0: ("b", "d", 3.0, 1.0),  # first of the best, last of the worst
        1: ("a", "b", 0.0, -1.0),  # no score counts as 0, a rating stands in
        4: ("a", "b", 5.0, 2.0),
        6: ("a", "c", 1.0, 1.0),  # all tied
    }


def test_bad_score_text_fails(spark):
    df = spark.createDataFrame([("p", "r", "high")], "prompt string, response string, score string")
    with pytest.raises(Exception):
        normalize.normalize_rewards(df, "x").collect()


def test_reward_single_and_unusable(spark):
    rows = [
        (0, "p", "r", 0.5, None, None),
        (1, "p", "r", None, 4, None),
        (2, "p", "r", None, None, None),
        (3, " ", "r", 1.0, None, None),
        (4, "p", " ", 1.0, None, None),
        (5, "p", "r", 2.0, None, "only chosen"),
    ]
    df = spark.createDataFrame(
        rows, "ord long, prompt string, response string, score double, rating int, chosen string"
    ).withColumn("rejected", F.array(F.lit("not text")))
    out = {r.ord: (r.chosen, r.rejected, r.score_chosen) for r in normalize.normalize_rewards(df, "x").collect()}
    assert out == {0: ("r", "", 0.5), 1: ("r", "", 4.0), 5: ("r", "", 2.0)}


def test_message_lists_are_no_pair(spark):
    df = spark.createDataFrame([("p", ["a"], ["b"])], "prompt string, chosen array<string>, rejected array<string>")
    assert normalize.normalize_rewards(df, "x").count() == 0


def test_pairs(spark):
    out = pairs.pairs_from_scores(
        records(spark, [(0, "1+1=?", "答案：2", "", "", 1.0, None), (1, "1+1=?", "答案：3", "", "", 0.0, None)])
    ).collect()
    assert [(r.chosen, r.rejected, r.metadata.source) for r in out] == [("答案：2", "答案：3", "score_pairwise")]


def test_pair_ties_answers_and_sources(spark):
    rows = [
        (4, "a", "r4", "", "", 2.0, "s4"),
        (1, "a", "r1", "", "w", 2.0, None),
        (7, "a", "r7", "x", "", 2.0, "s7"),
        (0, "b", "r0", "", "", None, "s"),
        (2, "b", "r2", "", "", 1.0, "s"),
        (3, "c", "r3", "", "", None, "s"),
        (5, "b", "r5", "", "late", 0.0, "s"),
        (6, "b", "r6", "", "", -0.0, "s"),
    ]
    out = {r.prompt: r for r in pairs.pairs_from_scores(records(spark, rows)).collect()}
    assert set(out) == {"a", "b"}
    a, b = out["a"], out["b"]
    assert (a.chosen, a.rejected, a.answer, a.metadata.source, a.first_ord) == ("r1", "r7", "w", "score_pairwise", 1)
    # An unscored row does not count as a response but is the prompt's first appearance.
    assert (b.chosen, b.rejected, b.answer, b.first_ord) == ("r2", "r6", "", 0)


def test_pairs_are_reduced_before_the_shuffle(spark):
    plan = pairs.pairs_from_scores(records(spark, [(0, "a", "r", "", "", 1.0, None)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan and "Window" not in plan


MIXED = [
    (0, "a", "r0", "", "", 1.0, "s"),
    (1, "a", "r1", "kept", "", 0.0, "s"),
    (2, "a", "r2", "lost", "", None, "s"),
]


def test_mode_switch(spark):
    mixed = records(spark, MIXED)
    # One open record sends all through the ranking: the unscored pair vanishes.
    assert [(r.chosen, r.rejected) for r in pairs.resolve_pairs(mixed).collect()] == [("r0", "r1")]
    closed = mixed.where("ord > 0")
    assert sorted((r.chosen, r.rejected) for r in pairs.resolve_pairs(closed).collect()) == [("r1", "kept"), ("r2", "lost")]
    per_row = pairs.resolve_pairs(mixed, mode="per_row").collect()
    assert sorted(r.chosen for r in per_row) == ["r1", "r2"]
    assert pairs.resolve_pairs(mixed, mode="pairs").count() == 2
    assert pairs.resolve_pairs(closed, mode="scored").count() == 0
    assert pairs.resolve_pairs(mixed.limit(0)).count() == 0


def test_blank_rejected_column_flips_too(spark):
    df = spark.createDataFrame(
        [(0, "p", "a", " "), (1, "p", "b", "c")], "ord long, prompt string, chosen string, rejected string"
    )
    assert pairs.convert_rewards(df, "x").count() == 0


def test_rank(spark):
    rows = [(i, "p", f"r{i}", "", "", float(s), None) for i, s in enumerate([1, 3, 3, 2])] + [(9, "p", "n", "", "", None, None)]
    out = pairs.rank_responses(records(spark, rows)).collect()
    assert [r.ord for r in sorted(out, key=lambda r: r.rank)] == [1, 2, 3, 0]
