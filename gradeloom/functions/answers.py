"""Answer extraction, normalisation and matching as Column expressions."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.fixed import MATCH_TOLERANCE
from gradeloom.functions.whitespace import (
    BLANK_CLASS,
    BLANKS,
    ColumnOrName,
    as_column,
    first_line,
    last_line,
    left_strip,
    let,
    right_strip,
    strip,
)

# The answer patterns. A heading may be followed by blank lines, and
# the answer is then whatever stands on the first non-blank line.
_BOX_OPEN = "\\boxed{"
_BOX = r"\\boxed\{([^}]*)\}"
_ANSWER_WORD = "答案"
_ANSWER_HEADING = rf"答案[:：]{BLANK_CLASS}*([^\n]+)"
_FINAL_ANSWER = rf"(?iu)final answer[:：]?{BLANK_CLASS}*([^\n]+)"
_FULL_STOPS = "。."
_MATHS_BRACKETS = ("\\(", "\\[", "\\)", "\\]")

# Number syntax accepted after normalisation (lower case, no blanks or commas).
_DECIMAL = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:e[+-]?0*\d{1,18})?|[+-]?inf(?:inity)?"
_NAN = r"[+-]?nan\d*"
_FRACTION = r"[+-]?\d+(?:_\d+)*/\d+(?:_\d+)*"


def _match(text: Column, pattern: str, position: int = 1) -> Column:
    """Group 1 of one match counted from either end; null when nothing matches."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(position))


def _heading(text: Column, pattern: str) -> Column:
    """Group 1 of the first match; null when nothing matches.

    The match takes in the rest of the text, so there is one, and the pattern runs once.
    """
    return _match(text, pattern + "(?s:.*)")


def extract_final_answer(text: ColumnOrName) -> Column:
    """Answer of a completion.

    The last boxed expression wins, then the first answer heading, then the last
    non-blank line without full stops around it. ``最终答案：`` needs no pattern of
    its own: the shorter heading inside it always matches first.
    """
    body = F.coalesce(as_column(text), F.lit(""))
    boxed = F.when(F.contains(body, F.lit(_BOX_OPEN)), _match(body, _BOX, -1))
    headed = F.when(F.contains(body, F.lit(_ANSWER_WORD)), _heading(body, _ANSWER_HEADING))
    return F.coalesce(
        strip(boxed),
        first_line(left_strip(F.coalesce(headed, _heading(body, _FINAL_ANSWER)))),
        F.btrim(last_line(right_strip(body)), F.lit(_FULL_STOPS)),
    )


def extract_source_answer(text: ColumnOrName) -> Column:
    """Answer of a worked solution in source data.

    Differs from :func:`extract_final_answer`: the first box counts and may be
    written in any case, captured text keeps all of its line, and full stops are
    removed from captures but not from the last-line fallback.
    """
    body = F.coalesce(as_column(text), F.lit(""))
    boxed = F.when(F.contains(body, F.lit("{")), _match(body, "(?iu)" + _BOX))
    headed = F.when(F.contains(body, F.lit(_ANSWER_WORD)), _heading(body, _ANSWER_HEADING))
    captured = F.coalesce(boxed, headed, _heading(body, _FINAL_ANSWER))
    return F.coalesce(F.btrim(strip(captured), F.lit(_FULL_STOPS)), last_line(strip(body)))


def normalize_answer(text: ColumnOrName) -> Column:
    """Canonical surface form: no maths delimiters, commas, blanks or outer stops."""
    cleaned = _without(F.coalesce(as_column(text), F.lit("")), ("$", *_MATHS_BRACKETS))
    # The first two characters are mapped, all others are dropped.
    cleaned = F.translate(cleaned, "−．," + BLANKS, "-.")
    return F.lower(F.btrim(cleaned, F.lit(_FULL_STOPS)))


def _without(text: Column, parts: Sequence[str]) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def _normalized_again(text: Column) -> Column:
    """:func:`normalize_answer` of a form that it has produced. ``text`` must be cheap to repeat.

    Such a form differs from its own only by brackets that closed up when something between
    their characters went, and these hold a backslash.
    """
    cleaned = F.btrim(_without(text, _MATHS_BRACKETS), F.lit(_FULL_STOPS))
    return F.when(F.contains(text, F.lit("\\")), cleaned).otherwise(text)


@functools.cache
def _digit_table() -> tuple[str, str]:
    """Every non-ASCII decimal digit and the ASCII digit it stands for."""
    digits = [
        (chr(code), str(unicodedata.decimal(chr(code))))
        for code in range(0x80, 0x110000)
        if unicodedata.decimal(chr(code), None) is not None
    ]
    return "".join(wide for wide, _ in digits), "".join(narrow for _, narrow in digits)


def _without_underscores(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def _ascii_digits(text: Column) -> Column:
    wide, narrow = _digit_table()
    has_wide = F.octet_length(text) != F.char_length(text)
    return F.when(has_wide, F.translate(text, wide, narrow)).otherwise(text)


def _value(text: Column, plain: Column) -> Column:
    """Number of normalised text with ASCII digits, null also for NaN. ``plain`` is the text
    without underscores. Both must be cheap to repeat.
    """

    def whole(position: int) -> Column:
        return F.substring_index(plain, "/", position).cast("double")

    return F.when(plain.rlike(rf"\A(?:{_DECIMAL})\z"), plain.cast("double")).when(
        F.contains(text, F.lit("/")) & text.rlike(rf"\A{_FRACTION}\z"),
        F.try_divide(whole(1), whole(-1)),
    )


def _parse(text: Column) -> Column:
    """Number of normalised text with ASCII digits. ``text`` must be cheap to repeat."""
    plain = _without_underscores(text)
    is_nan = F.contains(plain, F.lit("nan")) & plain.rlike(rf"\A{_NAN}\z")
    return F.coalesce(_value(text, plain), F.when(is_nan, F.lit(float("nan"))))


def parse_number(normalized: ColumnOrName) -> Column:
    """Double for a decimal or an integer fraction, else null.

    Takes text that :func:`normalize_answer` has produced.
    """
    return let(as_column(normalized), lambda text: let(_ascii_digits(text), _parse))


def to_number(text: ColumnOrName) -> Column:
    """Number written in ``text``, or null."""
    return parse_number(normalize_answer(text))


def numbers_close(left: Column, right: Column, tolerance: float = MATCH_TOLERANCE) -> Column:
    """Closeness with the tolerance read as both relative and absolute bound."""
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    size = F.greatest(F.abs(left), F.abs(right))
    bound = F.lit(tolerance) * F.greatest(size, F.lit(1.0))
    same = (left == right) & ~F.isnan(left)
    close = (size < float("inf")) & (F.abs(left - right) <= bound)
    return F.coalesce(same | close, F.lit(False))


def answers_match(
    predicted: ColumnOrName, target: ColumnOrName, tolerance: float = MATCH_TOLERANCE
) -> Column:
    """True when both answers have the same form or stand for the same number."""

    def compare(sides: Column) -> Column:
        # Numbers are read from the form normalised once more.
        numbers = F.struct(
            to_number(sides["p"]).alias("p"), to_number(sides["t"]).alias("t")
        )
        close = let(numbers, lambda n: numbers_close(n["p"], n["t"], tolerance))
        return F.when(sides["p"] == sides["t"], F.lit(True)).otherwise(close)

    return let(
        F.struct(normalize_answer(predicted).alias("p"), normalize_answer(target).alias("t")),
        compare,
    )


def exact_match(
    prediction: ColumnOrName, reference: ColumnOrName, tolerance: float = MATCH_TOLERANCE
) -> Column:
    """1.0 when the answer extracted from a completion matches, else 0.0."""
    return answers_match(extract_final_answer(prediction), reference, tolerance).cast("double")


def correctness_reward(
    output: ColumnOrName, gold_answer: ColumnOrName, tolerance: float = MATCH_TOLERANCE
) -> Column:
    """Reward for a correct final answer; see :func:`exact_match`."""
    return exact_match(output, gold_answer, tolerance)


def with_answer_match(
    df: DataFrame,
    predicted: ColumnOrName,
    target: ColumnOrName,
    output: str,
    tolerance: float = MATCH_TOLERANCE,
) -> DataFrame:
    """Add the result of :func:`answers_match` as a boolean column.

    Works in narrow steps, so every intermediate value is computed once inside
    generated code; prefer it to the expression form on large tables. The Java VM
    interprets a generated method beyond 8000 bytes, so the steps are kept short.
    """
    p, t = "__match_p", "__match_t"
    again = {p: "__again_p", t: "__again_t"}
    digits = {p: "__digits_p", t: "__digits_t"}
    plain = {p: "__plain_p", t: "__plain_t"}
    numbers = {p: "__number_p", t: "__number_t"}
    differs = F.col(p) != F.col(t)
    staged = (
        df.withColumns({p: normalize_answer(predicted), t: normalize_answer(target)})
        .withColumns({again[c]: F.when(differs, _normalized_again(F.col(c))) for c in (p, t)})
        .withColumns({digits[c]: _ascii_digits(F.col(again[c])) for c in (p, t)})
        .withColumns({plain[c]: _without_underscores(F.col(digits[c])) for c in (p, t)})
        # NaN is close to nothing, just as no number is.
        .withColumns({numbers[c]: _value(F.col(digits[c]), F.col(plain[c])) for c in (p, t)})
    )
    close = numbers_close(F.col(numbers[p]), F.col(numbers[t]), tolerance)
    helpers = [p, t, *again.values(), *digits.values(), *plain.values(), *numbers.values()]
    return staged.withColumn(output, ~differs | close).drop(*helpers)
