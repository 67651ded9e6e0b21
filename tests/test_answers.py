"""Extraction, normalisation and matching of answers, on hand-written cases."""

import math
import random
from decimal import Decimal, InvalidOperation
from fractions import Fraction

from pyspark.sql import functions as F

from gradeloom.functions import answers, whitespace


def check(values, function, cases):
    got = values([text for text, _ in cases], function("t"))
    assert got == [expected for _, expected in cases]


def test_final_answer(values):
    check(
        values,
        answers.extract_final_answer,
        [
            ("推导过程...\n\\boxed{7}", "7"),
            ("步骤：略\n答案：42", "42"),
            ("\\boxed{1} then \\boxed{ 2 }", "2"),
            ("\\boxed{\\frac{1}{2}}", "\\frac{1"),
            ("\\boxed{a \\boxed{b} c", "a \\boxed{b"),
            ("\\boxed{}\n答案：3", ""),
            ("\\boxed{no end\n答案：3", "3"),
            ("最终答案：5", "5"),
            ("答案：\n\n  42 \nmore", "42"),
            ("答案: 1\n答案: 2", "1"),
            ("答案：4\r5", "4"),
            ("答案：6\u20287", "6"),
            ("答案：  ", ""),
            ("答案：\n\n", "答案："),
            ("FINAL ANSWER 9", "9"),
            ("the final answer： x = 3", "x = 3"),
            ("f\u0131nal answer 8", "8"),
            ("line one\n\u3000last 。.\n \n", "last "),
            ("a\rb\x85c.\u2029", "c"),
            ("。。", ""),
            (" \n\t", ""),
            ("", ""),
            (None, ""),
        ],
    )


def test_source_answer(values):
    check(
        values,
        answers.extract_source_answer,
        [
            ("\\boxed{1.} then \\boxed{2}", "1"),
            ("\\BOXED{ 3。 }", "3"),
            ("\\boxed{}", ""),
            ("步骤：1+1=2\n答案：2", "2"),
            ("答案：4\r5.", "4\r5"),
            ("Final Answer: .7.", "7"),
            ("first\n last. \n", "last."),
            ("", ""),
        ],
    )


def test_normal_form(values):
    check(
        values,
        answers.normalize_answer,
        [
            (" 1,200 ", "1200"),
            ("$x$", "x"),
            ("\\( 3 \\)", "3"),
            ("\\[A\u3000B\\]", "ab"),
            ("\\$(5", "5"),
            ("−3．5。", "-3.5"),
            ("..。a.b。", "a.b"),
            ("１２", "１２"),
            ("\\ (5", "\\(5"),
        ],
    )


def test_to_number(values):
    inputs = [
        "1200", "1e3", ".5", "5.", "-.5e-1", "+7", "1_000", "_1__2_", "１２", "٣", "1d", "0x10", "1 000",
        "inf", "-Infinity", "+inf", "nan", "NaN12", "snan", "1/2", "-3/4", "+1_0/4", "1/-2", "1/2.0", "1/0",
        "1__0/2", "/2", "1/", "a/b", "", "abc", "1e400", "1e", "١/٢", "banana", "info",
    ]

    def expected(text):
        # The number syntax of Python's own Decimal and Fraction.
        compact = text.replace(" ", "").lower().strip(".。")
        try:
            return float(Decimal(compact)) if compact else None
        except (InvalidOperation, ValueError):
            pass
        try:
            return float(Fraction(compact)) if "/" in compact else None
        except (ValueError, ZeroDivisionError):
            return None

    for text, got in zip(inputs, values(inputs, answers.to_number("t"))):
        want = expected(text)
        if want is not None and math.isnan(want):
            assert got is not None and math.isnan(got), text
        else:
            assert got == want, text


def test_match(spark, values):
    cases = [
        (("0.5", "1/2"), True),
        (("1,200", "1200.0000001"), True),
        (("1000000", "1000000.9"), True),
        (("1000000", "1000002"), False),
        (("0", "0.000001"), True),
        (("0", "0.0000011"), False),
        (("nan", "NaN"), True),
        (("nan", "nan1"), False),
        (("inf", "Infinity"), True),
        (("inf", "1e308"), False),
        (("-inf", "inf"), False),
        (("", ""), True),
        (("", "0"), False),
        (("\\ (5", "5"), True),
        (("x", "$X$"), True),
        (("1d", "1"), False),
        ((None, ""), True),
    ]
    schema = "id int, p string, t string"
    assert values([pair for pair, _ in cases], answers.answers_match("p", "t"), schema) == [w for _, w in cases]
    df = spark.createDataFrame([(i, *pair) for i, (pair, _) in enumerate(cases)], schema)
    staged = answers.with_answer_match(df, "p", "t", "m").orderBy("id").select("m").collect()
    assert [row.m for row in staged] == [w for _, w in cases]
    assert df.columns == ["id", "p", "t"]


def test_tolerance(values):
    schema = "id int, p string, t string"
    assert values([("1", "1.05")], answers.answers_match("p", "t", 0.1), schema) == [True]
    assert values([("1", "1.05")], answers.answers_match("p", "t", 0.0), schema) == [False]


def test_exact_match_counts_empty_reference(values):
    cases = [("答案：4", "4"), ("答案：5", "4"), ("", ""), (" 。", "")]
    schema = "id int, p string, t string"
    assert values(cases, answers.exact_match("p", "t"), schema) == [1.0, 0.0, 1.0, 1.0]
    assert values(cases[:2], answers.correctness_reward("p", "t"), schema) == [1.0, 0.0]


def random_texts(count=400):
    rng = random.Random(7)
    alphabet = "ab.。 \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000\u200b答é"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(count)]


def test_whitespace_agrees_with_python(values):
    texts = random_texts()
    assert values(texts, whitespace.strip("t")) == [t.strip() for t in texts]
    assert values(texts, whitespace.word_count("t")) == [len(t.split()) for t in texts]
    lines = [[x for x in (line.strip() for line in t.splitlines()) if x] for t in texts]
    assert values(texts, whitespace.clean_lines("t")) == lines
    body = whitespace.strip("t")
    assert values(texts, whitespace.first_line(body)) == [(x or [""])[0] for x in lines]
    assert values(texts, whitespace.last_line(body)) == [(x or [""])[-1] for x in lines]
    assert values(texts, whitespace.is_blank("t")) == [not t.strip() for t in texts]


def test_class_covers_exactly_the_blanks(values):
    every = [chr(code) for code in range(1, 0x10000) if not 0xD800 <= code < 0xE000]
    found = values(every, F.col("t").rlike(whitespace.BLANK_CLASS))
    assert {c for c, hit in zip(every, found) if hit} == set(whitespace.BLANKS) == {c for c in every if c.isspace()}
    ends = values(every, F.size(F.split(F.concat(F.lit("a"), "t", F.lit("b")), whitespace._LINE_END)) > 1)
    assert {c for c, hit in zip(every, ends) if hit} == set(whitespace.LINE_ENDS)


def test_long_blank_runs_stay_cheap(values):
    text = "a" + " " * 200_000 + "b\n" + "\u3000" * 200_000 + "c" + "\t" * 200_000
    assert values([text], whitespace.word_count("t")) == [3]
    assert values([text], F.size(whitespace.clean_lines("t"))) == [2]
    assert values([text], answers.extract_final_answer("t")) == ["c"]
