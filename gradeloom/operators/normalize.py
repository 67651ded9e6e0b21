"""Raw question-and-answer tables to the fixed record types.

Candidate columns are looked up when the plan is built, so only those present are
read. Work is laid out in narrow steps: texts are stripped once in the first and
chosen from in the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import fixed
from gradeloom.functions.answers import extract_source_answer
from gradeloom.functions.prompts import rl_prompt, with_tutor_response
from gradeloom.functions.whitespace import strip
from gradeloom.operators.limits import prefix_limit

# Column that carries each row's own key list when the input is ragged.
RAW_KEYS = "raw_keys__"


def _string_fields(schema: T.StructType, candidates: Sequence[str]) -> list[str]:
    types = {field.name: field.dataType for field in schema.fields}
    return [name for name in candidates if isinstance(types.get(name), T.StringType)]


def first_filled(stripped: Sequence[Column], default: Column | None = None) -> Column:
    """First non-empty of several stripped texts, else ``default`` (or empty)."""
    fallback = F.lit("") if default is None else default
    if not stripped:
        return fallback
    return F.coalesce(*[F.when(text != "", text) for text in stripped], fallback)


def pick_first(df: DataFrame, candidates: Sequence[str], default: Column | None = None) -> Column:
    """First candidate column that is text and not blank, stripped."""
    return first_filled([strip(F.col(name)) for name in _string_fields(df.schema, candidates)], default)


def metadata(df: DataFrame, source_name: str, ord_col: str = "ord") -> Column:
    """Source tag and the sorted names of the raw row's fields."""
    if RAW_KEYS in df.columns:
        keys = F.array_sort(F.col(RAW_KEYS))
    else:
        names = sorted(name for name in df.columns if name != ord_col)
        keys = F.array(*[F.lit(name) for name in names]).cast("array<string>")
    return F.struct(F.lit(source_name).alias("source"), keys.alias("raw_keys"))


def _stage(df: DataFrame, wanted: Sequence[str], source_name: str, ord_col: str, *extra: Column) -> DataFrame:
    """Keep the stripped candidate texts, the metadata and the ordinal."""
    texts = [strip(F.col(n)).alias(f"s_{n}") for n in dict.fromkeys(_string_fields(df.schema, wanted))]
    carried = [F.col(ord_col)] if ord_col in df.columns else []
    return df.select(*texts, metadata(df, source_name, ord_col).alias("metadata"), *carried, *extra)


def _pick(staged: DataFrame, candidates: Sequence[str], default: Column | None = None) -> Column:
    present = [F.col(f"s_{name}") for name in candidates if f"s_{name}" in staged.columns]
    return first_filled(present, default)


def _carried(staged: DataFrame, ord_col: str) -> list[str]:
    return [ord_col] if ord_col in staged.columns else []


def normalize_sft(
    df: DataFrame, source_name: str, limit: int | None = None, ord_col: str = "ord"
) -> DataFrame:
    """Rows of any question-and-solution table as ``prompt, response, answer, metadata``."""
    raw = prefix_limit(df, limit, ord_col)
    wanted = (*fixed.SFT_PROMPT_FIELDS, *fixed.SFT_SOLUTION_FIELDS, *fixed.SFT_ANSWER_FIELDS)
    staged = _stage(raw, wanted, source_name, ord_col)
    picked = staged.select(
        _pick(staged, fixed.SFT_PROMPT_FIELDS).alias("prompt"),
        _pick(staged, fixed.SFT_SOLUTION_FIELDS).alias("solution"),
        _pick(staged, fixed.SFT_ANSWER_FIELDS, F.lit(None).cast("string")).alias("given"),
        "metadata",
        *_carried(staged, ord_col),
    )
    answered = picked.withColumn(
        "answer", F.coalesce(F.col("given"), extract_source_answer("solution"))
    )
    worked = F.when(F.col("solution") != "", F.col("solution")).otherwise(F.col("answer"))
    return with_tutor_response(answered.withColumn("worked", worked), "worked", "answer", "response").select(
        "prompt", "response", "answer", "metadata", *_carried(staged, ord_col)
    )


def normalize_rl(
    df: DataFrame, source_name: str, limit: int | None = None, ord_col: str = "ord"
) -> DataFrame:
    """Rows of any question table as prompt-only records. No row is dropped."""
    raw = prefix_limit(df, limit, ord_col)
    staged = _stage(raw, (*fixed.RL_QUESTION_FIELDS, *fixed.RL_ANSWER_FIELDS), source_name, ord_col)
    return staged.select(
        rl_prompt(_pick(staged, fixed.RL_QUESTION_FIELDS)).alias("prompt"),
        _pick(staged, fixed.RL_ANSWER_FIELDS).alias("answer"),
        "metadata",
        *_carried(staged, ord_col),
    )


def score_of(fields: Sequence[str], read, keys: Column | None = None) -> Column:
    """Score as a double, or the rating when there is no score.

    With the row's own field names in ``keys`` a score that is there but null stays
    null. Without them an absent field cannot be told from a null one, so a null score
    also falls back to the rating.
    """
    present = [name for name in fixed.SCORE_FIELDS if name in fields]
    if not present:
        return F.lit(None).cast("double")
    values = [read(name).cast("double") for name in present]
    if keys is None:
        return F.coalesce(*values)
    chosen = F.lit(None).cast("double")
    for name, value in reversed(list(zip(present, values))):
        chosen = F.when(F.array_contains(keys, name), value).otherwise(chosen)
    return chosen


def ranked_completions(completions: Column, item: T.StructType) -> Column:
    """Usable completions of a row as ``score, back, text``; ``back`` breaks ties.

    A completion counts when it has text; a missing score counts as 0.0.
    """
    texts = _string_fields(item, fixed.COMPLETION_TEXT_FIELDS)

    def own_keys(part: Column) -> Column | None:
        return part[RAW_KEYS] if RAW_KEYS in item.fieldNames() else None

    def entry(part: Column, position: Column) -> Column:
        return F.struct(
            F.coalesce(score_of(item.fieldNames(), lambda name: part[name], own_keys(part)), F.lit(0.0)).alias("score"),
            (-position).alias("back"),
            first_filled([strip(part[name]) for name in texts]).alias("text"),
        )

    entries = F.transform(completions, entry)
    return F.filter(entries, lambda part: part["text"] != "")


def completion_ends(ranked: Column) -> tuple[Column, Column]:
    """Best and worst entry: the first of the highest and the last of the lowest."""
    return F.array_max(ranked), F.array_min(ranked)


def _completion_item(df: DataFrame) -> T.StructType | None:
    for field in df.schema.fields:
        if field.name == "completions" and isinstance(field.dataType, T.ArrayType):
            item = field.dataType.elementType
            return item if isinstance(item, T.StructType) else None
    return None


def normalize_rewards(
    df: DataFrame, source_name: str, limit: int | None = None, ord_col: str = "ord"
) -> DataFrame:
    """Rows of any preference table as reward records.

    A row is read as a chosen/rejected pair, else as a list of scored completions,
    else as one scored response; a row that is none of these is dropped.
    """
    raw = prefix_limit(df, limit, ord_col)
    item = _completion_item(raw)
    pair_fields = _string_fields(raw.schema, ("chosen", "rejected"))
    keys = F.col(RAW_KEYS) if RAW_KEYS in raw.columns else None
    extra = [score_of(raw.columns, F.col, keys).alias("given_score")]
    if item is not None:
        extra.append(ranked_completions(F.col("completions"), item).alias("ranked"))
        extra.append(F.size("completions").alias("listed"))
    wanted = (
        *fixed.REWARD_PROMPT_FIELDS,
        *fixed.REWARD_ANSWER_FIELDS,
        *fixed.REWARD_RESPONSE_FIELDS,
        *(pair_fields if len(pair_fields) == 2 else ()),
    )
    staged = _stage(raw, wanted, source_name, ord_col, *extra)
    is_pair = (
        F.col("s_chosen").isNotNull() & F.col("s_rejected").isNotNull()
        if len(pair_fields) == 2
        else F.lit(False)
    )
    if item is not None:
        is_list = F.coalesce((F.col("listed") >= 2) & (F.size("ranked") >= 2), F.lit(False))
        best, worst = completion_ends(F.col("ranked"))
    else:
        is_list, best, worst = F.lit(False), None, None
    picked = staged.select(
        _pick(staged, fixed.REWARD_PROMPT_FIELDS).alias("prompt"),
        _pick(staged, fixed.REWARD_ANSWER_FIELDS).alias("answer"),
        _pick(staged, fixed.REWARD_RESPONSE_FIELDS).alias("response"),
        F.when(is_pair, F.lit("pair")).when(is_list, F.lit("list")).alias("shape"),
        *([F.when(is_list, best).alias("best"), F.when(is_list, worst).alias("worst")] if item else []),
        *([F.col("s_chosen"), F.col("s_rejected")] if len(pair_fields) == 2 else []),
        "given_score",
        "metadata",
        *_carried(staged, ord_col),
    )
    single = (F.col("prompt") != "") & (F.col("response") != "") & F.col("given_score").isNotNull()
    shaped = picked.withColumn("shape", F.coalesce(F.col("shape"), F.when(single, F.lit("single"))))

    def by_shape(pair: str | None, listed: str | None, one: Column) -> Column:
        value = F.when(F.col("shape") == "single", one)
        if listed is not None and item is not None:
            value = value.when(F.col("shape") == "list", F.col(listed))
        if pair is not None and len(pair_fields) == 2:
            value = value.when(F.col("shape") == "pair", F.col(pair))
        return value

    record = F.struct(
        F.col("prompt"),
        by_shape("s_chosen", "best.text", F.col("response")).alias("chosen"),
        by_shape("s_rejected", "worst.text", F.lit("")).alias("rejected"),
        F.col("answer"),
        by_shape(None, "best.score", F.col("given_score")).alias("score_chosen"),
        by_shape(None, "worst.score", F.lit(None).cast("double")).alias("score_rejected"),
        F.col("metadata"),
        *[F.col(name) for name in _carried(staged, ord_col)],
    )
    # Expanding to no row drops what has no shape. A filter would be moved below the
    # steps above and work out the shape a second time.
    return shaped.select(F.inline(F.when(F.col("shape").isNotNull(), F.array(record))))
