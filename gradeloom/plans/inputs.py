"""Input tables of the registered queries, derived from the given tables.

Expressions are kept as SQL text where another engine can run the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.operators.ordered import with_ordinal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, all by default."""
    return table(spark, sf_dir, name).select(*(columns or "*"))


# Order lines with their whole-number quantity as number and as text.
LINES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_returnflag": "l_returnflag",
    "number": "CAST(l_quantity AS INT)",
    "qty": "CAST(CAST(l_quantity AS INT) AS STRING)",
}
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")

# Completions with known answers: one per order line, in six styles.
COMPLETIONS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_returnflag": "l_returnflag",
    "prompt": "CONCAT('p', CAST(l_partkey AS STRING))",
    "gold": "qty",
    "response": """CASE CAST(l_orderkey % 6 AS INT)
        WHEN 0 THEN CONCAT('思路：a', chr(10), '步骤：b', chr(10), '答案：', qty)
        WHEN 1 THEN CONCAT('x ', chr(92), 'boxed{', CAST(number + l_linenumber % 2 AS STRING), '}')
        WHEN 2 THEN CONCAT('Final answer: ', CAST(2 * number AS STRING), '/2')
        WHEN 3 THEN CONCAT('so we get', chr(10), qty, '.')
        WHEN 4 THEN CONCAT('答案：', chr(10), qty, '.0')
        ELSE '' END""",
}

# Answers in many surface forms, to be normalised and read as numbers.
ANSWER_FORMS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "form": """CASE CAST(l_orderkey % 12 AS INT)
        WHEN 0 THEN CONCAT('$', qty, '$')
        WHEN 1 THEN CONCAT(' ', qty, ',000 ')
        WHEN 2 THEN CONCAT(chr(92), '(', qty, '/4', chr(92), ')')
        WHEN 3 THEN CONCAT('−', qty, '．5')
        WHEN 4 THEN CONCAT(qty, 'E1。')
        WHEN 5 THEN CONCAT(qty, 'd')
        WHEN 6 THEN CONCAT(qty, '/0')
        WHEN 7 THEN CONCAT('1_', qty)
        WHEN 8 THEN CONCAT('　', translate(qty, '0123456789', '０１２３４５６７８９'))
        WHEN 9 THEN CASE WHEN l_linenumber % 2 = 0 THEN '-Infinity' ELSE 'NaN' END
        WHEN 10 THEN CONCAT(qty, '　.', ' ')
        ELSE CONCAT('.', qty) END""",
    "target": """CASE WHEN l_linenumber % 3 = 0 THEN CONCAT(qty, '.0')
        WHEN l_linenumber % 3 = 1 THEN CONCAT(qty, '/4')
        ELSE CONCAT('−', qty, '.5000001') END""",
}

# Scored responses: equal scores are common, some are missing.
SCORED_RESPONSES = {
    "ord": "event_id",
    "prompt": "CONCAT('user ', CAST(user_id AS STRING))",
    "chosen": "CONCAT('response ', CAST(event_id AS STRING))",
    "rejected": "''",
    "answer": "CASE WHEN event_id % 3 = 0 THEN '' ELSE CONCAT('a', CAST(event_id AS STRING)) END",
    "score_chosen": "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(FLOOR(value) AS DOUBLE) END",
    "score_rejected": "CAST(NULL AS DOUBLE)",
    "source": "CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING) ELSE event_type END",
}

# A metrics log: the event type is the run, steps repeat, metrics have gaps.
METRICS_LOG = {
    "run": "event_type",
    "ord": "event_id",
    "step": "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS BIGINT) ELSE user_id END",
    "mean_reward": "CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END",
    "mean_format_reward": "CASE WHEN event_type = 'click' THEN CAST(NULL AS DOUBLE) ELSE value * 2 END",
    "tokens_per_sec": "CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE CAST(NULL AS DOUBLE) END",
    "elapsed_sec": "CAST(NULL AS DOUBLE)",
}

# Preference rows in every accepted shape and some that fit none.
_ITEM_TEXT = "CONCAT(' view ', CAST(event_id AS STRING), '{part} ')"
PREFERENCE_FIELDS = {
    "ord": "event_id",
    "prompt": "CASE WHEN event_id % 4 = 0 THEN '  ' ELSE CONCAT(' user ', CAST(user_id AS STRING)) END",
    "question": "CONCAT('q', CAST(user_id AS STRING), '　')",
    "answer": "CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE CONCAT(CAST(user_id AS STRING), ' ') END",
    "chosen": "CASE WHEN event_type = 'click' THEN CONCAT('　good ', CAST(event_id AS STRING)) END",
    "rejected": "CASE WHEN event_type = 'click' AND event_id % 11 <> 0 THEN CONCAT('bad ', CAST(event_id AS STRING), ' ') END",
    "response": "CASE WHEN event_type IN ('error', 'click') THEN CONCAT('one ', CAST(event_id AS STRING)) END",
    "score": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN FLOOR(value) END",
    "rating": "CASE WHEN event_id % 5 <> 0 THEN user_id % 10 END",
}
PREFERENCE_ITEMS = (
    (_ITEM_TEXT.format(part="a"), "CAST(FLOOR(value / 100) AS DOUBLE)"),
    (_ITEM_TEXT.format(part="b"), "CAST(user_id % 6 AS DOUBLE)"),
    ("CASE WHEN event_id % 3 = 0 THEN '  ' ELSE " + _ITEM_TEXT.format(part="c") + " END", "CAST(NULL AS DOUBLE)"),
    (_ITEM_TEXT.format(part="d"), "CAST(event_id % 4 AS DOUBLE)"),
)


# Ragged objects: a list with a score, a rating and a null score beside a rating; a null
# score beside a rating; a rating alone; a score alone.
RAGGED_PREFERENCES = """CONCAT('{"ord":', CAST(9007199254740992 + event_id AS STRING), ',"prompt":"user ', CAST(user_id AS STRING), '",',
    CASE CAST(event_id % 4 AS INT)
      WHEN 0 THEN CONCAT('"completions":[{"text":"a', CAST(event_id AS STRING), '","score":', CAST(CAST(FLOOR(value) AS BIGINT) AS STRING),
        '},{"content":" b","rating":', CAST(user_id % 6 AS STRING), '},7,{"text":"c","score":null,"rating":5}]')
      WHEN 1 THEN '"response":"one","score":null,"rating":3'
      WHEN 2 THEN CONCAT('"response":"two","rating":', CAST(user_id % 10 AS STRING))
      ELSE CONCAT('"response":" three ","answer":"x","score":"', CAST(CAST(FLOOR(value) AS BIGINT) AS STRING), '.5"') END, '}')"""

# Lines most of which are JSON objects.
MIXED_LINES = """CASE CAST(event_id % 23 AS INT) WHEN 0 THEN CONCAT('{"ord":', CAST(event_id AS STRING)) WHEN 1 THEN CONCAT('[', CAST(event_id AS STRING), ']')
    WHEN 2 THEN '  ' WHEN 3 THEN CONCAT('{} ', CAST(event_id AS STRING)) ELSE CONCAT(' {"ord":', CAST(event_id AS STRING), '} ') END"""

# Responses and answers that meet by position.
ZIPPED_RESPONSES = {
    "response": """CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 2 = 0 THEN CONCAT('思路：a', chr(10), '步骤：b', chr(10), '答案：', CAST(user_id % 4 AS STRING))
        ELSE CONCAT('x ', chr(92), 'boxed{', CAST(user_id % 4 AS STRING), '.0}') END"""
}
ZIPPED_ANSWERS = {"answer": "CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE CAST(o_orderkey % 4 AS STRING) END"}


def select_all(df: DataFrame, expressions: dict[str, str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.expr(text).alias(name) for name, text in expressions.items()])


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = texts(spark, sf_dir, "lineitem", *LINE_COLUMNS)
    return select_all(select_all(lines, LINES), COMPLETIONS)


def answer_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = texts(spark, sf_dir, "lineitem", *LINE_COLUMNS)
    return select_all(select_all(lines, LINES), ANSWER_FORMS)


def scored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select_all(table(spark, sf_dir, "events"), SCORED_RESPONSES)
    metadata = F.struct("source", F.lit(None).cast("array<string>").alias("raw_keys"))
    return rows.withColumn("metadata", metadata).drop("source")


def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_all(table(spark, sf_dir, "events"), METRICS_LOG)


def preference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ", ".join(
        f"named_struct('text', {text}, 'score', {score})" for text, score in PREFERENCE_ITEMS
    )
    listed = f"""CASE WHEN event_type = 'view' THEN array({items})
        WHEN event_type = 'signup' THEN slice(array({items}), 3, 1) END"""
    events = texts(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    return select_all(events, {**PREFERENCE_FIELDS, "completions": listed})


def question_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn whose next turn in order is the assistant's, with that turn.

    Turn numbers may have gaps. All turns are numbered in order, by ranges, and the next
    one is then an equality on that number: the join spreads over it however long one
    conversation is. The number of the user's turn is the ordinal.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    numbered = with_ordinal(turns, ["conv_id", "turn"])
    asked = numbered.where(F.col("role") == "user").select(
        "conv_id", "ord", (F.col("ord") + 1).alias("next"), F.col("text").alias("question")
    )
    answered = numbered.where(F.col("role") == "assistant").select(
        "conv_id", F.col("ord").alias("next"), F.col("text").alias("solution")
    )
    return asked.join(answered, ["conv_id", "next"]).select("ord", "question", "solution")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: every event as latency, the document of the same number as reply."""
    documents = texts(spark, sf_dir, "documents", "doc_id", "text", "lang")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("value").alias("latency_sec")
    )
    return events.join(documents, "doc_id", "left")
