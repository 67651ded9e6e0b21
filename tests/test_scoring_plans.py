"""Generated code of the scoring queries, and the short cuts that keep it small."""

import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gradeloom.functions import answers
from gradeloom.operators.scoring import score_completions
from gradeloom.plans import catalog, inputs

# The Java VM only interprets a method above this size, which costs several times the CPU time.
LARGEST_COMPILED = 8000

LINES = pa.schema(
    [("l_orderkey", pa.int64()), ("l_linenumber", pa.int32()), ("l_partkey", pa.int64()), ("l_quantity", pa.float64()), ("l_returnflag", pa.string())]
)


@pytest.fixture
def folder(tmp_path):
    rows = [(key, key % 7, key % 5, float(key % 50), "ANR"[key % 3]) for key in range(60)]
    rows += [(None, 1, 1, 1.0, "A"), (61, None, None, None, None), (3, 3, 3, 3.0, "A"), (3, 3, 3, 3.0, "A")]
    pq.write_table(pa.Table.from_pylist([dict(zip(LINES.names, row)) for row in rows], LINES), f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def largest_method(df):
    module = getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(module, "MODULE$").codegenString(df._jdf.queryExecution().executedPlan())
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code))


@pytest.fixture
def planning(spark):
    """A session whose plans hold their generated stages from the start."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    return session


def test_scored_completions_stay_compiled(planning, folder):
    scored = score_completions(inputs.completions(planning, folder), answer="gold")
    assert largest_method(scored) < LARGEST_COMPILED


def test_reward_means_stay_compiled(planning, folder):
    assert largest_method(catalog.QUERIES["reward_means"](planning, folder)) < LARGEST_COMPILED


def test_extraction_strips_each_end_once(spark, values):
    texts = ["答案： \u3000a b\u3000 \\x\r c", " \n\u3000 d e \u2028\n ", "\u3000", "答案： \x0b \n\u3000", "x\u3000\n\u3000y\u3000z\u3000", "final answer\u3000 7 "]
    assert values(texts, answers.extract_final_answer("t")) == ["a b\u3000 \\x", "d e", "", "", "y\u3000z", "7"]
    df = spark.range(1).select(F.uuid().alias("t")).select(answers.extract_final_answer("t").alias("e"))
    # Both ends of what a box holds and of full stops; other answers lose the blanks of each end once.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert [len(re.findall(rf"\b{name}\(", plan)) for name in ("trim", "ltrim", "rtrim")] == [2, 2, 2]


def test_second_normal_form(values):
    rng = random.Random(5)
    texts = ["".join(rng.choices("\\\\()[]$ ,.。−．\u3000aΣİ5", k=rng.randint(0, 9))) for _ in range(3000)]
    once = values(texts, answers.normalize_answer("t"))
    twice = values(once, answers.normalize_answer("t"))
    assert sum(a != b for a, b in zip(once, twice)) > 20
    assert values(once, answers._normalized_again(F.col("t"))) == twice


def test_lower_case_has_a_lower_case_of_its_own(values):
    every = [chr(code) for code in range(1, 0x1F000) if not 0xD800 <= code < 0xE000]
    low = values(every, F.lower("t"))
    assert values(low, F.lower("t")) == low
    kept = [c for c in every if c not in "$,−．" and not c.isspace()]
    assert not {x for c in values(kept, F.lower("t")) for x in c} & {*"$,−．", *" \u3000"}


def test_first_heading_wins(values):
    texts = ["答案：1\n答案：2\nx", "答案：\n\n 3 \n答案：4", "答案 5", "Final answer 6\r7\nfinal answer 8", "", "答案：", "答案： "]
    assert values(texts, answers.extract_final_answer("t")) == ["1", "3", "答案 5", "6", "", "答案：", ""]


def test_odd_rows_are_scored(spark):
    rows = [
        (1, None, None, None), (2, "答案：3", "x", "3"), (2, "答案：3", "x", "3"), (3, "nan", "x", "nan1"), (4, "", "", ""),
        (5, "\\boxed{1/0}", "x", "1"), (6, "答案：-inf", "x", "inf"), (7, "答案：1_0/2", "x", "5"), (8, "\\boxed{\\ (٣}", "x", "3.0"),
        (9, "答案：1e400", "x", "Infinity"), (10, "答案：NaN", "x", "1"), (11, "1", "x", "nan"),
    ]
    df = spark.createDataFrame(rows, "id int, response string, prompt string, answer string")
    got = sorted((r.id, r.predicted_answer, r.correctness_reward) for r in score_completions(df).collect())
    assert got == [
        (1, "", 0.0), (2, "3", 1.0), (2, "3", 1.0), (3, "nan", 0.0), (4, "", 0.0), (5, "1/0", 0.0), (6, "-inf", 0.0),
        (7, "1_0/2", 1.0), (8, "\\ (٣", 1.0), (9, "1e400", 1.0), (10, "NaN", 0.0), (11, "1", 0.0),
    ]


def test_stream_of_odd_rows_is_scored_whole(spark, folder):
    out = catalog.QUERIES["stream_scores"](spark, folder)
    assert out.count() == 64
    assert out.where("l_orderkey IS NULL OR l_linenumber IS NULL").count() == 2
