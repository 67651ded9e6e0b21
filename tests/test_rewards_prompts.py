"""Rewards, prompts, chat texts and the hooks for user models."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import fixed
from gradeloom.functions import prompts, rewards
from gradeloom.operators import scoring

GOOD = "思路：直接相加\n步骤：1+3=4\n答案：4"


@pytest.fixture
def steady_scorer():
    def factory():
        class Steady:
            def score(self, prompt, response):
                return 0.8

        return Steady()

    return factory


@pytest.fixture
def completions(spark):
    rows = [(0, "1+3=?", GOOD, "4"), (1, "1+3=?", GOOD, ""), (2, "1+3=?", "", "4"), (3, "", "答案：5", None)]
    return spark.createDataFrame(rows, "id int, prompt string, response string, answer string")


def test_format_reward(values):
    texts = ["思路：先列式\n步骤：逐步求解\n答案：4", "答案", "", None]
    assert values(texts, rewards.format_reward("t")) == [1.0, 1 / 3, 0.0, 0.0]
    assert values(texts, rewards.format_reward("t", [])) == [1.0, 1 / 3, 0.0, 0.0]
    # A repeated section counts once as present but every time in the total.
    assert values(texts, rewards.format_reward("t", ["答案", "答案", "x"])) == [1 / 3, 1 / 3, 0.0, 0.0]
    assert values(["答案"], rewards.section_flags("t", ["答案", "x", "答案"])) == [{"答案": True, "x": False}]
    assert values(["答案"], rewards.passes_threshold(rewards.format_reward("t"), 1 / 3)) == [True]


def test_combined_reward(completions, steady_scorer):
    scored = scoring.score_completions(completions, scorer=steady_scorer).orderBy("id").collect()
    first = scored[0]
    assert (first.correctness_reward, first.format_reward, first.rlaif_reward) == (1.0, 1.0, 0.8)
    assert first.combined_reward == 0.5 * 1.0 + 0.3 * 0.8 + 0.2 * 1.0
    assert scored[1].correctness_reward == 0.0  # nothing to compare with
    assert scored[2].combined_reward == 0.3 * 0.8
    assert scored[3].correctness_reward == 0.0 and scored[3].predicted_answer == "5"


def test_combined_reward_without_scorer(completions):
    plain = scoring.score_completions(completions, weights=rewards.RewardWeights(1.0, 5.0, 0.0))
    assert [row.combined_reward for row in plain.orderBy("id").collect()] == [1.0, 0.0, 0.0, 0.0]
    assert "PythonUDF" not in plain._jdf.queryExecution().toString()
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()


def test_batch_scorer_and_own_tables(spark, completions):
    def factory():
        class Lengths:
            def score_batch(self, prompts, responses):
                return [float(len(r)) for r in responses]

        return Lengths()

    scored = scoring.reward_values(completions, scorer=factory, weights=rewards.RewardWeights(0, 1, 0))
    assert [row.reward for row in scored.orderBy("id").collect()] == [float(len(GOOD)), float(len(GOOD)), 0.0, 4.0]
    assert scored.columns == [*completions.columns, "reward"]
    messages = completions.select(
        "id",
        F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("prompt"),
        F.struct(F.lit("assistant").alias("role"), F.col("response").alias("content")).alias("response"),
    )
    no_answers = scoring.score_completions(messages, answer=None).orderBy("id").collect()
    assert [row.combined_reward for row in no_answers][:2] == [0.2 * 1.0, 0.2 * 1.0]


def test_wrong_number_of_scores_fails(completions):
    def factory():
        class Short:
            def score_batch(self, prompts, responses):
                return []

        return Short()

    with pytest.raises(Exception, match="one value per response"):
        scoring.score_completions(completions, scorer=factory).collect()


def test_generation(completions):
    def factory():
        return lambda texts: [text.upper() for text in texts]

    out = scoring.generate_completions(completions, factory, "response", "made").orderBy("id").collect()
    assert out[3].made == "答案：5" and out[0].prompt == "1+3=?"


def test_models_are_called_once_per_row(completions, steady_scorer):
    kept = scoring.score_completions(completions, scorer=steady_scorer).where("combined_reward > 0.5")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and kept.count() == 1


def test_tutor_response(values):
    text = "\u3000first \r\n\n second\n答案：2."
    expected = (
        fixed.TUTOR_OVERVIEW + "思路：\nfirst\n\n步骤：\nfirst\nsecond\n答案：2.\n\n答案：\n{}\n\n" + fixed.TUTOR_SUMMARY
    )
    assert values([text], prompts.tutor_response("t", F.lit("9"))) == [expected.format("9")]
    assert values([text], prompts.tutor_response("t", F.lit(""))) == [expected.format("2")]
    empty = (
        fixed.TUTOR_OVERVIEW
        + "思路：\n先分析题目条件，再逐步求解。\n\n步骤：\n请根据题目条件逐步推导。\n\n答案：\n待求\n\n"
        + fixed.TUTOR_SUMMARY
    )
    assert values([" \n", ""], prompts.tutor_response("t", F.lit(""))) == [empty, empty]


def test_tutor_response_in_steps(spark):
    rows = [("\u3000a \r\n\n b\n答案：2.", "9"), (" \n", ""), ("a. ", None)]
    df = spark.createDataFrame(rows, "t string, a string")
    both = prompts.with_tutor_response(df, "t", "a", "x").select("x", prompts.tutor_response("t", "a").alias("y"))
    assert all(row.x == row.y for row in both.collect())


def test_prompts(values):
    assert values(["　求 2+2\n"], prompts.rl_prompt("t"))[0].endswith("题目：求 2+2")
    assert values([" q "], prompts.user_prompt("t")) == ["请讲解并解答下面的数学题：\nq"]
    assert values(["q"], prompts.tutor_generation_prompt("t"))[0].startswith(fixed.TUTOR_SYSTEM_PROMPT + "\n\n请讲解")
    assert values(["r"], rewards.scorer_text(F.lit("p"), "t")) == ["问题：p\n\n回答：r"]
    assert values(["r"], prompts.sft_text(F.lit("p"), "t", "s")) == ["<|system|>\ns\n<|user|>\np\n<|assistant|>\nr"]
    chat = prompts.chat_messages(F.lit("p"), "t", "s")
    assert values(["r"], prompts.flatten_messages(chat)) == [
        "SYSTEM:\ns\n\nUSER:\np\n\nASSISTANT:\nr\n\nASSISTANT:\n"
    ]


def test_flatten_turns(spark):
    rows = [(1, 10, "user", "b"), (1, 9, "system", "a"), (2, 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv int, turn int, role string, text string")
    out = {r.conv: r.prompt for r in prompts.flatten_turns(df, "conv", "turn", "role", "text").collect()}
    assert out == {1: "SYSTEM:\na\n\nUSER:\nb\n\nASSISTANT:\n", 2: "USER:\nc\n\nASSISTANT:\n"}


def test_chat_template_hook(spark):
    def factory():
        class Tags:
            def apply_chat_template(self, messages, tokenize=True, add_generation_prompt=True):
                text = "|".join(m["role"] + m["content"] for m in messages)
                return [1, 2] if tokenize else text + "+cue" * add_generation_prompt

        return Tags()

    df = spark.createDataFrame([("q", "r")], "q string, r string")
    text = df.select(scoring.chat_template_udf(factory)(prompts.chat_messages("q", "r", "s")).alias("x"))
    assert text.first().x == "systems|userq|assistantr"


def test_completion_text(spark):
    schema = T._parse_datatype_string(
        "s string, one struct<role:string,content:string>, many array<struct<content:string>>, "
        "nested array<array<string>>, n int, b boolean, other struct<x:int>, m map<string,string>, "
        "ms array<map<string,string>>, d double, k map<string,int>"
    )
    df = spark.createDataFrame(
        [("a", ("u", "b"), [("c",), ("",), (None,), ("d",)], [["e"], ["", "f"]], 5, True, (1,),
          {"role": "u", "content": "hi"}, [{"content": "x"}, {"role": "u"}], 1e16, {"x": 1})], schema
    )
    texts = df.select(*[prompts.completion_text(f.name, f.dataType).alias(f.name) for f in schema.fields]).first()
    assert tuple(texts) == ("a", "b", "c\nNone\nd", "e\nf", "5", "True", "", "hi", "x", "1e+16", "")


def test_safe_rate(values):
    cases = [(6.0, 3.0), (6.0, 0.0), (6.0, -1.0)]
    assert values(cases, rewards.safe_rate("a", "b"), "id int, a double, b double") == [2.0, 0.0, 0.0]
