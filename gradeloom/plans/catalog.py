"""The registered queries, one per operator of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom import fixed, schemas
from gradeloom.fixed import REQUIRED_SECTIONS, SUMMARY_METRICS
from gradeloom.functions import answers, prompts, rewards, whitespace
from gradeloom.operators import evaluation, exports, limits, normalize, ordered, pairs, runs, sampling, scoring, tables, zipping
from gradeloom.plans import inputs, jobs
from gradeloom.plans.inputs import table, texts
from gradeloom.runtime import scratch_path
from gradeloom.sources import datasets, jsonl, reports
from gradeloom.streaming import metrics_log, pairs as stream_pair_log, scoring as stream_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_LINE_KEY = ("l_orderkey", "l_linenumber")


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Answers ---------------------------------------------------------------------


@registered
def extract_final_answer(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    return df.select(*_LINE_KEY, answers.extract_final_answer("response").alias("predicted"))


@registered
def extract_final_answer_documents(spark, sf_dir):
    df = texts(spark, sf_dir, "documents")
    return df.select("doc_id", answers.extract_final_answer("text").alias("predicted"))


@registered
def extract_source_answer(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    return df.select(*_LINE_KEY, answers.extract_source_answer("response").alias("answer"))


@registered
def extract_source_answer_pages(spark, sf_dir):
    df = texts(spark, sf_dir, "pages")
    return df.select("page_id", answers.extract_source_answer("html").alias("answer"))


@registered
def normalize_answer(spark, sf_dir):
    df = inputs.answer_forms(spark, sf_dir)
    return df.select(*_LINE_KEY, answers.normalize_answer("form").alias("normalized"))


@registered
def normalize_answer_documents(spark, sf_dir):
    df = texts(spark, sf_dir, "documents")
    return df.select("doc_id", answers.normalize_answer("text").alias("normalized"))


@registered
def to_number(spark, sf_dir):
    df = inputs.answer_forms(spark, sf_dir)
    df = df.select(*_LINE_KEY, answers.to_number("form").alias("n"))
    number = F.col("n")
    finite = F.abs(number) < float("inf")
    return df.select(
        *_LINE_KEY,
        F.when(number.isNull(), "none")
        .when(F.isnan(number), "nan")
        .when(finite, "finite")
        .when(number > 0, "inf")
        .otherwise("-inf")
        .alias("kind"),
        F.when(finite, number).alias("number"),
    )


@registered
def answers_match(spark, sf_dir):
    df = answers.with_answer_match(inputs.answer_forms(spark, sf_dir), "form", "target", "matches")
    return df.select(*_LINE_KEY, F.col("matches").cast("int").alias("matches"))


@registered
def exact_match(spark, sf_dir):
    rows = inputs.completions(spark, sf_dir)
    return rows.select(*_LINE_KEY, answers.exact_match("response", "gold").alias("exact_match"))


# Rewards ---------------------------------------------------------------------


@registered
def section_flags(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    flags = df.select(*_LINE_KEY, rewards.section_flags("response", REQUIRED_SECTIONS).alias("flags"))
    return flags.select(
        *_LINE_KEY,
        *[F.col("flags")[name].cast("int").alias(f"has_{i}") for i, name in enumerate(REQUIRED_SECTIONS)],
    )


@registered
def format_reward(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    repeated = ("思路", "思路", "答案", "boxed")
    return df.select(
        *_LINE_KEY,
        F.round(rewards.format_reward("response"), 6).alias("standard"),
        F.round(rewards.format_reward("response", ()), 6).alias("no_sections"),
        F.round(rewards.format_reward("response", repeated), 6).alias("own_sections"),
    )


@registered
def format_threshold(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    return df.select(
        *_LINE_KEY,
        rewards.passes_threshold(rewards.format_reward("response")).cast("int").alias("passes"),
        rewards.passes_threshold(rewards.format_reward("response"), 0.3).cast("int").alias("passes_low"),
    )


@registered
def score_completions(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    scored = scoring.score_completions(df, answer="gold")
    return scored.select(
        *_LINE_KEY,
        "predicted_answer",
        "correctness_reward",
        "rlaif_reward",
        F.round("format_reward", 6).alias("format_reward"),
        F.round("combined_reward", 6).alias("combined_reward"),
    )


@registered
def reward_values(spark, sf_dir):
    """Completions as message lists, one shared answer, own weights."""
    df = inputs.completions(spark, sf_dir)
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.lit("").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("response").alias("content")),
    )
    shaped = df.select(*_LINE_KEY, "prompt", messages.alias("completion"), F.lit("17").alias("answer"))
    scored = scoring.reward_values(
        shaped, response="completion", weights=rewards.RewardWeights(1.0, 0.0, 0.5)
    )
    return scored.select(*_LINE_KEY, F.round("reward", 6).alias("reward"))


@registered
def scorer_text(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    return df.select(*_LINE_KEY, rewards.scorer_text("prompt", "response").alias("text"))


@registered
def model_scores(spark, sf_dir):
    """Rewards with a user's batch scorer in the model part."""

    def factory():
        class LengthScorer:
            def score_batch(self, prompts, responses):
                return [(len(p) + 2 * len(r)) % 10 / 10 for p, r in zip(prompts, responses)]

        return LengthScorer()

    df = inputs.completions(spark, sf_dir)
    scored = scoring.score_completions(df, answer="gold", scorer=factory)
    return scored.select(
        *_LINE_KEY,
        F.round("rlaif_reward", 6).alias("rlaif_reward"),
        F.round("combined_reward", 6).alias("combined_reward"),
    )


@registered
def row_scorer(spark, sf_dir):
    """The model part with a scorer that takes one response at a time."""

    def factory():
        class LengthScorer:
            def score(self, prompt, response):
                return (len(prompt) + 2 * len(response)) % 10 / 10

        return LengthScorer()

    scored = scoring.score_completions(inputs.completions(spark, sf_dir), answer="gold", scorer=factory)
    return scored.select(*_LINE_KEY, F.round("rlaif_reward", 6).alias("rlaif_reward"))


@registered
def generated_completions(spark, sf_dir):
    """Completions by a user's model, here one that states the prompt's length."""

    def factory():
        return lambda texts: [f"思路：a\n答案：{len(text)}" for text in texts]

    df = texts(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("question"), prompts.rl_prompt("text").alias("prompt")
    )
    made = scoring.generate_completions(df, factory)
    return evaluation.eval_rows(made, reference="none", keep=("doc_id",))


@registered
def chat_template(spark, sf_dir):
    def factory():
        class Tags:
            # Tokenises unless told not to, as common tokenizers do.
            def apply_chat_template(self, messages, tokenize=True, add_generation_prompt=True):
                text = "".join(f"[{m['role']}]{m['content']}" for m in messages)
                return [len(text)] if tokenize else text + "[assistant]" * add_generation_prompt

        return Tags()

    pairs_ = inputs.question_pairs(spark, sf_dir)
    messages = prompts.chat_messages("question", "solution")
    return pairs_.select("ord", scoring.chat_template_udf(factory)(messages).alias("text"))


@registered
def completion_text(spark, sf_dir):
    df = inputs.completions(spark, sf_dir)
    message = F.struct(F.lit("assistant").alias("role"), F.col("response").alias("content"))
    shaped = df.select(
        *_LINE_KEY,
        F.col("response").alias("plain"),
        message.alias("one"),
        F.array(message, F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("many"),
        F.col("l_linenumber").alias("number"),
    )
    return shaped.select(
        *_LINE_KEY,
        *[prompts.completion_text(n, shaped.schema[n].dataType).alias(n) for n in ("plain", "one", "many", "number")],
    )


# Evaluation ------------------------------------------------------------------


def _eval_input(spark, sf_dir):
    df = inputs.completions(spark, sf_dir).withColumnRenamed("response", "prediction")
    return evaluation.eval_rows(df, question="prompt", reference="gold", keep=("l_returnflag", *_LINE_KEY))


@registered
def eval_rows(spark, sf_dir):
    return _eval_input(spark, sf_dir).drop("l_returnflag")


@registered
def eval_summary(spark, sf_dir):
    rows = _eval_input(spark, sf_dir).withColumns(
        {"dataset": F.lit("lines"), "split": F.col("l_returnflag")}
    )
    summary = evaluation.eval_summary(rows)
    return summary.select(
        "dataset",
        "split",
        "samples",
        F.round("final_answer_accuracy", 6).alias("final_answer_accuracy"),
        F.round("format_pass_rate", 6).alias("format_pass_rate"),
    )


@registered
def eval_summary_total(spark, sf_dir):
    rows = _eval_input(spark, sf_dir)
    return evaluation.eval_summary(rows, by=(), threshold=0.3).select(
        "samples",
        F.round("final_answer_accuracy", 6).alias("final_answer_accuracy"),
        F.round("format_pass_rate", 6).alias("format_pass_rate"),
    )


@registered
def join_predictions(spark, sf_dir):
    """Predictions and references from two tables, matched by document."""
    predictions = texts(spark, sf_dir, "documents").select(
        "doc_id", "source", F.concat("text", F.lit("\n答案："), F.col("n_chars") % 2).alias("prediction")
    )
    references = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("answer")
    )
    joined = evaluation.join_by_key(predictions, references, "doc_id")
    rows = evaluation.eval_rows(joined, question="source", keep=("doc_id",))
    return evaluation.with_exact_match(rows).drop("prediction")


# Prompts and texts -----------------------------------------------------------


@registered
def clean_lines(spark, sf_dir):
    df = texts(spark, sf_dir, "documents").select(
        "doc_id", whitespace.clean_lines("text").alias("lines")
    )
    return df.select("doc_id", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("joined"))


@registered
def word_count(spark, sf_dir):
    df = texts(spark, sf_dir, "documents")
    return df.select("doc_id", whitespace.word_count("text").alias("words"))


@registered
def tutor_response(spark, sf_dir):
    df = texts(spark, sf_dir, "documents")
    answer = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.lit(""))
    return prompts.with_tutor_response(
        df.select("doc_id", "text", answer.alias("answer")), "text", "answer", "response"
    ).select("doc_id", "response")


@registered
def rl_prompts(spark, sf_dir):
    df = texts(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.lit(" 　").alias("question"),
        F.col("text").alias("problem"),
        F.col("n_chars").alias("answer"),
        F.col("lang").alias("target"),
    )
    return normalize.normalize_rl(df, "docs").select(
        "ord", "prompt", "answer", F.concat_ws(",", "metadata.raw_keys").alias("raw_keys")
    )


@registered
def user_prompts(spark, sf_dir):
    df = texts(spark, sf_dir, "documents")
    return df.select(
        "doc_id",
        prompts.user_prompt("text").alias("prompt"),
        prompts.tutor_generation_prompt("text").alias("full_prompt"),
    )


@registered
def sft_unified(spark, sf_dir):
    df = normalize.normalize_sft(inputs.question_pairs(spark, sf_dir), "talks")
    return df.select(
        "ord",
        "prompt",
        "response",
        "answer",
        F.col("metadata.source").alias("source"),
        F.concat_ws(",", "metadata.raw_keys").alias("raw_keys"),
    )


@registered
def pick_first(spark, sf_dir):
    df = inputs.preference_rows(spark, sf_dir)
    return df.select(
        "ord",
        normalize.pick_first(df, ("prompt", "question")).alias("picked"),
        normalize.pick_first(df, ("rating", "score", "absent"), F.lit("none")).alias("not_text"),
    )


@registered
def sft_chat(spark, sf_dir):
    df = normalize.normalize_sft(inputs.question_pairs(spark, sf_dir), "talks")
    chat = df.select("ord", F.posexplode(prompts.chat_messages("prompt", "response", "你是数学老师。")))
    return chat.select("ord", F.col("pos").alias("position"), "col.role", "col.content")


@registered
def sft_text(spark, sf_dir):
    df = inputs.question_pairs(spark, sf_dir)
    return df.select("ord", prompts.sft_text("question", "solution").alias("text"))


@registered
def flatten_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return prompts.flatten_turns(turns, "conv_id", "turn", "role", "text")


@registered
def flatten_messages(spark, sf_dir):
    df = inputs.question_pairs(spark, sf_dir)
    return df.select(
        "ord", prompts.flatten_messages(prompts.chat_messages("question", "solution")).alias("prompt")
    )


# Pairs -----------------------------------------------------------------------


def _flat_records(df, ordinal="ord"):
    return df.select(
        F.col(ordinal).alias("ord"),
        "prompt",
        "chosen",
        "rejected",
        "answer",
        "score_chosen",
        "score_rejected",
        F.col("metadata.source").alias("source"),
    )


@registered
def reward_records(spark, sf_dir):
    return _flat_records(normalize.normalize_rewards(inputs.preference_rows(spark, sf_dir), "mixed"))


@registered
def score_fallback(spark, sf_dir):
    df = inputs.preference_rows(spark, sf_dir)
    return df.select("ord", normalize.score_of(df.columns, F.col).alias("score"))


@registered
def completions_array_pair(spark, sf_dir):
    """Best and worst of a four-item list on every event."""
    items = ", ".join(
        f"named_struct('text', {text}, 'rating', {score})" for text, score in inputs.PREFERENCE_ITEMS
    )
    df = inputs.select_all(
        texts(spark, sf_dir, "events"),
        {"ord": "event_id", "prompt": "event_type", "completions": f"array({items})"},
    )
    return _flat_records(normalize.normalize_rewards(df, "lists")).drop("answer", "source")


@registered
def pairs_from_scores(spark, sf_dir):
    df = pairs.pairs_from_scores(inputs.scored_responses(spark, sf_dir))
    return _flat_records(df, "first_ord")


@registered
def rank_responses(spark, sf_dir):
    ranked = pairs.rank_responses(inputs.scored_responses(spark, sf_dir))
    return ranked.select("ord", "prompt", "score_chosen", "rank")


@registered
def reward_mode_switch(spark, sf_dir):
    """Records of all shapes, some without a rejected text: ranked per prompt."""
    df = pairs.convert_rewards(inputs.preference_rows(spark, sf_dir), "mixed")
    return _flat_records(df, "first_ord")


@registered
def reward_complete_pairs(spark, sf_dir):
    """Only finished pairs: kept as they are."""
    df = texts(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.col("source").alias("query"),
        F.concat(F.lit(" "), "text").alias("chosen"),
        F.col("lang").alias("rejected"),
    )
    return _flat_records(pairs.convert_rewards(df, "docs"), "first_ord")


@registered
def reward_per_row(spark, sf_dir):
    """Finished pairs kept and open records ranked among themselves."""
    df = pairs.convert_rewards(inputs.preference_rows(spark, sf_dir), "mixed", mode="per_row")
    return _flat_records(df, "first_ord")


# Runs ------------------------------------------------------------------------


@registered
def latest_metric(spark, sf_dir):
    return runs.latest_metrics(inputs.metrics_log(spark, sf_dir))


@registered
def last_known_metric(spark, sf_dir):
    log = inputs.metrics_log(spark, sf_dir)
    carried = runs.last_known_metrics(log, ("mean_reward", "tokens_per_sec"))
    return carried.select("run", "ord", "last_mean_reward", "last_tokens_per_sec")


@registered
def compare_runs(spark, sf_dir):
    return runs.compare_runs(inputs.metrics_log(spark, sf_dir), "click", "view")


@registered
def report_lines(spark, sf_dir):
    comparison = runs.compare_runs(inputs.metrics_log(spark, sf_dir), "click", "view")
    return runs.report_lines(comparison, "click", "view")


@registered
def curves(spark, sf_dir):
    return runs.align_curves(
        inputs.metrics_log(spark, sf_dir), "click", "view", ("mean_reward", "tokens_per_sec")
    )


@registered
def curve_points(spark, sf_dir):
    return runs.curve_points(inputs.metrics_log(spark, sf_dir), "mean_reward")


@registered
def reward_means(spark, sf_dir):
    scored = scoring.score_completions(inputs.completions(spark, sf_dir), answer="gold")
    stepped = scored.withColumns({"run": F.col("l_returnflag"), "step": F.col("l_linenumber")})
    means = runs.reward_means(stepped)
    return means.select("run", "step", *[F.round(c, 6).alias(c) for c in means.columns[2:]])


@registered
def group_advantage(spark, sf_dir):
    scored = scoring.score_completions(inputs.completions(spark, sf_dir), answer="gold")
    advantage = runs.group_advantage(scored)
    return advantage.select(
        *_LINE_KEY,
        "prompt",
        F.round("group_mean", 6).alias("group_mean"),
        F.round("advantage", 4).alias("advantage"),
    )


@registered
def latency_summary(spark, sf_dir):
    summary = runs.latency_summary(inputs.requests(spark, sf_dir))
    return summary.select("repeats", *[F.round(c, 6).alias(c) for c in summary.columns[1:]])


@registered
def latency_by_language(spark, sf_dir):
    summary = runs.latency_summary(inputs.requests(spark, sf_dir), by=("lang",))
    return summary.select("lang", "repeats", *[F.round(c, 6).alias(c) for c in summary.columns[2:]])


@registered
def latency_events(spark, sf_dir):
    """Exact median of every event's value per type, words from its properties."""
    log = table(spark, sf_dir, "events")
    summary = runs.latency_summary(log, by=("event_type",), latency="value", text="props")
    return summary.select("event_type", "repeats", *[F.round(c, 6).alias(c) for c in summary.columns[2:]])


@registered
def safe_rate(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    rate = rewards.safe_rate(F.col("l_extendedprice"), F.col("l_quantity") - 25)
    return df.select(*_LINE_KEY, rate.alias("rate"))


# Limits, splits and table upkeep ---------------------------------------------


@registered
def prefix_limit(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return limits.prefix_limit(df, 4_000, "o_orderkey")


@registered
def eval_sample(spark, sf_dir):
    df = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "ord")
    return limits.prefix_limit(df, 200).select("ord", "text")


@registered
def split_slice(spark, sf_dir):
    df = datasets.load_dataset(spark, sf_dir, "events[200:700]", ord_col="event_id")
    return df.select("event_id", "event_type", "value")


@registered
def calibration_sample(spark, sf_dir):
    df = normalize.normalize_rl(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("text").alias("question")),
        "docs",
    )
    return datasets.first_prompts(df, 128)


@registered
def input_ordinal(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ordered.with_ordinal(df, [F.col("lang").desc(), F.col("doc_id")])


@registered
def registry_upsert(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")
    )
    current = nation.where(F.col("region") < 3)
    changes = nation.where(F.col("region") > 1).withColumn("region", F.col("region") + 100)
    return tables.upsert(current, changes)


@registered
def unified_sources(spark, sf_dir):
    talks = inputs.question_pairs(spark, sf_dir)
    docs = texts(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("source").alias("instruction"), F.col("text").alias("output"), F.col("lang").alias("label")
    )
    df = tables.unify_sources({"talks": talks, "docs": docs})
    return df.select("ord", "prompt", "answer", "response", F.col("metadata.source").alias("source"))


@registered
def prompt_difficulty(spark, sf_dir):
    scored = scoring.score_completions(inputs.completions(spark, sf_dir), answer="gold")
    hard = sampling.prompt_difficulty(scored)
    return hard.select("prompt", "completions", F.round("difficulty", 6).alias("difficulty"))


@registered
def harder_subset(spark, sf_dir):
    """A third of all prompts, the harder ones more."""
    scored = scoring.score_completions(inputs.completions(spark, sf_dir), answer="gold")
    # A part's lines show little spread, so a prompt here is a part of one flag.
    asked = scored.withColumn("prompt", F.concat_ws(" ", "prompt", "l_returnflag"))
    prompts_ = sampling.prompt_difficulty(asked)
    n = table(spark, sf_dir, "part").count()
    chosen = sampling.harder_subset(prompts_, n, edges=(0.4, 0.5, 0.6), weights=(1, 2, 3, 4))
    return chosen.select("prompt", "stratum", F.round("difficulty", 6).alias("difficulty"))


def _zip_parts(spark, sf_dir):
    """Prompts, responses and answers from three tables of different lengths."""
    asked = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "lang", "source").alias("prompt"))
    given = inputs.select_all(table(spark, sf_dir, "events"), inputs.ZIPPED_RESPONSES, "event_id")
    known = inputs.select_all(table(spark, sf_dir, "orders"), inputs.ZIPPED_ANSWERS, "o_orderkey")
    return (asked, "prompt", ["doc_id"]), (given, "response", [F.col("event_id").desc()]), (known, "answer", ["o_orderkey"])


@registered
def zip_scores(spark, sf_dir):
    """Rewards of responses that meet prompts and answers by position."""
    scored = zipping.score_zipped(*_zip_parts(spark, sf_dir))
    return scored.select("position", "prompt", "answer", "predicted_answer", "correctness_reward", F.round("combined_reward", 6).alias("combined_reward"))


@registered
def zip_accuracy(spark, sf_dir):
    _, responses, answers_ = _zip_parts(spark, sf_dir)
    accuracy = zipping.accuracy_zipped(responses, answers_)
    return accuracy.select("samples", F.round("final_answer_accuracy", 6).alias("final_answer_accuracy"))


@registered
def zip_report(spark, sf_dir):
    """How many rows each table has, and how many find no partner."""
    names = ("prompt", "response", "answer")
    return zipping.Zipped(dict(zip(names, _zip_parts(spark, sf_dir)))).report()


@registered
def hash_split(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", tables.is_validation("doc_id", 0.02).cast("int").alias("validation"))


# Files and streams -----------------------------------------------------------


@registered
def jsonl_round_trip(spark, sf_dir):
    """Written as JSON Lines and read back strictly, nulls and all texts included."""
    df = inputs.preference_rows(spark, sf_dir).select("ord", "question", "answer", "chosen", "rating")
    path = jsonl.write_jsonl(df, scratch_path(spark, "jsonl"))
    return jsonl.read_jsonl(spark, path, df.schema)


@registered
def ragged_jsonl(spark, sf_dir):
    """Objects with differing fields: absent fields, wrong types and key lists."""
    lines = inputs.preference_rows(spark, sf_dir).select(F.to_json(F.struct("ord", "prompt", "question", "answer", "rating", "chosen")))
    path = scratch_path(spark, "ragged")
    lines.write.text(path)
    df = jsonl.read_ragged_jsonl(spark, path, ("prompt", "question", "answer", "target"), whole_fields=("ord",))
    rl = normalize.normalize_rl(df, "ragged")
    return rl.select("ord", "prompt", "answer", F.concat_ws(",", "metadata.raw_keys").alias("raw_keys"))


@registered
def ragged_rewards(spark, sf_dir):
    """Preference objects with absent, null and present scores, alone and in lists."""
    lines = table(spark, sf_dir, "events").select(F.expr(inputs.RAGGED_PREFERENCES))
    path = scratch_path(spark, "ragged")
    lines.write.text(path)
    df = jsonl.read_ragged_jsonl(
        spark, path, ("prompt", "response", "answer"), fixed.SCORE_FIELDS, ("ord",), completions=True
    )
    return _flat_records(normalize.normalize_rewards(df, "ragged"))


@registered
def records_source(spark, sf_dir):
    """Rows held by the caller, numbered, with the events they name."""
    held = [{"event_type": name, "weight": weight} for weight, name in enumerate(("view", "click", "absent"))]
    rows = datasets.from_records(spark, held, "event_type string, weight long", "ord")
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return rows.join(counts, "event_type", "left")


@registered
def report_file(spark, sf_dir):
    """The Markdown report written and read back line by line."""
    comparison = runs.compare_runs(inputs.metrics_log(spark, sf_dir), "click", "view")
    path = reports.write_report(runs.report_lines(comparison, "click", "view"), scratch_path(spark, "report"))
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("position", "line"))
    return lines


@registered
def compare_job_curves(spark, sf_dir):
    """The curves that the comparison of two runs writes."""
    folder = scratch_path(spark, "comparison")
    jobs.compare_and_report(inputs.metrics_log(spark, sf_dir), "click", "view", folder)
    schema = ", ".join(["step long", *[f"{m}_{side} double" for m in ("mean_reward", "tokens_per_sec") for side in "ab"]])
    return spark.read.schema(schema).option("header", True).csv(f"{folder}/curves.csv")


@registered
def registry_entries(spark, sf_dir):
    """One dataset per source, then a change for every third document; the last of a name wins."""
    path = scratch_path(spark, "registry")
    name = F.concat("source", F.lit("_train")).alias("name")
    docs = table(spark, sf_dir, "documents")
    first = docs.select(name, F.concat("source", F.lit(".jsonl")).alias("file_name")).distinct()
    reports.register_datasets(spark, path, reports.registry_entries(spark, first, exports.CHAT_LAYOUT))
    changes = docs.where("doc_id % 3 = 0 AND source < 'src5'").select(
        name, F.concat_ws("_", "source", F.col("doc_id").cast("string")).alias("file_name"), F.col("doc_id").alias("at")
    )
    changed = reports.registry_entries(spark, changes, exports.PREFERENCE_LAYOUT, keep=["at"])
    reports.register_datasets(spark, path, changed, order="at")
    entries = reports.read_registry(spark, path)
    return entries.select("name", "file_name", "formatting", F.coalesce(F.col("ranking"), F.lit(False)).cast("int").alias("ranking"))


@registered
def invalid_lines(spark, sf_dir):
    """Every line of a folder that is no JSON object."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(F.expr(inputs.MIXED_LINES)).write.text(path)
    return jsonl.invalid_jsonl_lines(spark, path).select("line", (F.col("line_number") > 0).cast("int").alias("numbered"))


@registered
def append_log(spark, sf_dir):
    """A log written in two appends and read as one table."""
    log = inputs.metrics_log(spark, sf_dir)
    path = scratch_path(spark, "log")
    metrics_log.append_metrics(log.where("run = 'click'"), path)
    metrics_log.append_metrics(log.where("run <> 'click'"), path)
    return runs.latest_metrics(metrics_log.read_metrics(spark, path))


@registered
def reuse_or_build(spark, sf_dir):
    """Built once, then reused: the second build would fail if it ran."""
    source = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("source").alias("question"), F.col("lang").alias("answer")
    )
    schema = schemas.with_ordinal_field(schemas.RL_PROMPT)
    path = scratch_path(spark, "prepared")

    def rebuild():
        raise AssertionError("a complete table must be reused")

    jsonl.reuse_or_build(spark, {path: lambda: normalize.normalize_rl(source, "docs")}, schema)
    reused = jsonl.reuse_or_build(spark, {path: rebuild}, schema)[path]
    return reused.select("ord", "prompt", "answer", "metadata.source")


@registered
def csv_round_trip(spark, sf_dir):
    log = inputs.metrics_log(spark, sf_dir).select("run", "ord", "step", "mean_reward")
    path = reports.write_csv(log, scratch_path(spark, "csv"))
    return spark.read.schema(log.schema).option("header", True).csv(path)


@registered
def summary_file(spark, sf_dir):
    rows = _eval_input(spark, sf_dir).withColumns({"dataset": F.lit("lines"), "split": F.lit("all")})
    path = reports.write_summary(evaluation.eval_summary(rows), scratch_path(spark, "summary"))
    schema = "dataset string, split string, samples long, final_answer_accuracy double, format_pass_rate double"
    return spark.read.schema(schema).json(path).select(
        "dataset",
        "split",
        "samples",
        F.round("final_answer_accuracy", 6).alias("final_answer_accuracy"),
        F.round("format_pass_rate", 6).alias("format_pass_rate"),
    )


def _exported(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = jsonl.write_jsonl(df, scratch_path(spark, "export"))
    return jsonl.read_jsonl(spark, path, df.schema)


@registered
def export_chat(spark, sf_dir):
    records = normalize.normalize_sft(inputs.question_pairs(spark, sf_dir), "talks")
    chat = _exported(exports.chat_table(records, "你是数学老师。"))
    return chat.select(
        F.concat_ws("|", "messages.role").alias("roles"),
        F.concat_ws("|", "messages.content").alias("contents"),
        "answer",
        F.col("metadata.source").alias("source"),
    )


@registered
def export_preference(spark, sf_dir):
    records = pairs.pairs_from_scores(inputs.scored_responses(spark, sf_dir))
    out = _exported(exports.preference_table(records))
    return out.select("prompt", "chosen", "rejected", "answer", F.to_json("metadata").alias("metadata"))


@registered
def export_in_order(spark, sf_dir):
    """Pairs written by many tasks and read back line by line in the order of their prompts."""
    records = pairs.pairs_from_scores(inputs.scored_responses(spark, sf_dir))
    ordered_ = exports.preference_table(records, "first_ord")
    path = jsonl.write_ordered_jsonl(ordered_, scratch_path(spark, "export"), ["first_ord"], drop=["first_ord"])
    lines = jsonl.numbered_lines(spark, path)
    row = jsonl.decode_json("value", "prompt string, chosen string, rejected string")
    return lines.select("ord", row.alias("row")).select("ord", "row.*")


@registered
def export_instruction(spark, sf_dir):
    df = texts(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.col("text").alias("question"), F.col("lang").alias("answer")
    )
    out = _exported(exports.instruction_table(normalize.normalize_rl(df, "docs")))
    return out.select("instruction", "input", "output", "answer", F.col("metadata.source").alias("source"))


@registered
def json_codec(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", jsonl.decode_json("props", "k int, absent string").alias("p")
    )
    return df.select("event_id", F.col("p.k").alias("k"), jsonl.encode_json("p.k", "p.absent").alias("encoded"))


@registered
def stream_scores(spark, sf_dir):
    """Completions that arrive as a stream, scored into a table."""
    known = table(spark, sf_dir, "lineitem")
    lines = datasets.stream_dataset(spark, sf_dir, known.schema, pathGlobFilter="lineitem.parquet")
    arriving = inputs.select_all(inputs.select_all(lines, inputs.LINES), inputs.COMPLETIONS)
    target = scratch_path(spark, "scores")
    query = stream_scoring.score_stream(
        arriving, target, scratch_path(spark, "progress"), once=True, answer="gold"
    )
    query.awaitTermination()
    scored = spark.read.parquet(target)
    return scored.select(*_LINE_KEY, "predicted_answer", F.round("combined_reward", 6).alias("combined_reward"))


@registered
def stream_pairs(spark, sf_dir):
    """Pairs kept up to date from records that arrive in several batches."""
    records = inputs.scored_responses(spark, sf_dir)
    folder, target, progress = (scratch_path(spark, label) for label in ("records", "ends", "progress"))
    records.repartition(4, "ord").write.parquet(folder)
    arriving = datasets.stream_dataset(spark, folder, records.schema, maxFilesPerTrigger="1")
    stream_pair_log.follow_pairs(arriving, target, progress, every=2, once=True).awaitTermination()
    return _flat_records(stream_pair_log.read_pairs(spark, target), "first_ord")


@registered
def stream_latest_metrics(spark, sf_dir):
    """Latest metrics kept up to date from a growing log."""
    events = datasets.stream_dataset(
        spark, sf_dir, table(spark, sf_dir, "events").schema, pathGlobFilter="events.parquet"
    )
    target = scratch_path(spark, "latest")
    query = metrics_log.follow_latest(
        inputs.select_all(events, inputs.METRICS_LOG), target, scratch_path(spark, "progress"), once=True
    )
    query.awaitTermination()
    return metrics_log.read_latest(spark, target).select("run", *SUMMARY_METRICS)
