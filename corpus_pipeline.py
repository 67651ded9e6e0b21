"""The corpus pipeline: documents through five stages, each written and reread.

Every stage takes all rows that the one before it kept and lets its decisions take
effect. All but the last return the columns of ``documents``; extra columns stay.

1. language: rows whose language cannot be told go (no letters, or a text unlike every
   learned language). Learned from the rows with a language: the profiles, and for each
   language and length of text the least cosine of texts that are like the others, which
   is three quartile distances below the lower quartile. Rows without language are held to
   the same bounds.
2. near duplicates: one document of each group of near copies stays, the one with the
   smallest id. Texts without words are nobody's copies.
3. decontamination: rows that hold a test item of ``benchmark`` go.
4. mixing: rows are taken as often as the mix of their source asks, zero to three times.
5. tokens: all rows as token ids in binary files; one row per document comes back.

Stage 2 decides on rows by a key of its own and stage 3 by the digest of the text, so rows
without id and rows that repeat an id are searched and dropped each for itself.

Stages that hand texts to Python bound the session's Arrow batches (``bound_text_batches``),
which stays so for the session.

No rows give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import bbit_minhash, decontaminate, hyper_lang, pareto_mix, pfor_blocks
from gradeloom.llm.common import sized, stored, stored_alone, table
from gradeloom.runtime import bound_text_batches

TOKENIZER = "byte_bpe_50k.json"
# Quartiles tell something from so many rows on, and differ by chance by the noise of a cosine.
ROWS_LEAST, NOISE, FENCE = 20, 1 / hyper_lang.DIMENSIONS**0.5, 3
# Where no quartiles tell anything: no language, from so many letters (as a power of two) on.
SCORE_LEAST, SIZE_LEAST = 0.05, 4


def language_bounds(found: DataFrame) -> DataFrame:
    """lang_pred, size, bound; null stands for any language."""
    own = found.where(F.col("row.lang") == F.col("lang_pred"))
    quartiles = F.percentile_approx("score", [0.25, 0.75], 10_000)
    sets = own.rollup("size", "lang_pred").agg(quartiles.alias("q"), F.count(F.lit(1)).alias("n"))
    sets = sets.where(F.col("size").isNotNull() & (F.col("n") >= ROWS_LEAST))
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(NOISE))
    return sets.select("lang_pred", "size", (F.col("q")[0] - FENCE * spread).alias("bound"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_text_batches(spark)
    found = hyper_lang.identify(docs, F.lit(True)).where(F.col("lang_pred") != hyper_lang.UNKNOWN)
    # Lengths by powers of two, in letters: signs and digits tell no language.
    letters = F.length(F.regexp_replace("row.text", r"\P{L}+", ""))
    found = stored(found.withColumn("size", F.floor(F.log2(letters.cast("double"))).cast("int")), "languages")
    bounds = stored(language_bounds(found), "language-bounds")

    lang, size = F.col("lang_pred"), F.col("size")
    exact = bounds.where(lang.isNotNull()).select(lang.alias("l"), size.alias("s"), F.col("bound").alias("exact"))
    # Longer texts lie closer to their language: what holds for a shorter one holds for them.
    known = bounds.where(lang.isNull()).select(size.alias("known"), "bound")
    sizes = spark.range(64).select(F.col("id").cast("int").alias("any_size"))
    below = sizes.join(F.broadcast(known), F.col("known") <= F.col("any_size")).groupBy("any_size").agg(F.max_by("bound", "known").alias("shorter"))
    joined = found.join(sized(stored(exact, "language-exact")), (lang == F.col("l")) & (size == F.col("s")), "left")
    joined = joined.join(F.broadcast(below), size == F.col("any_size"), "left")
    bound = F.coalesce("exact", "shorter", F.when(size >= SIZE_LEAST, SCORE_LEAST).otherwise(0.0))
    return joined.where(F.col("score") >= bound).select("row.*")


def near_copies(rows: DataFrame) -> DataFrame:
    """The rows to drop: of each group all but the one with the smallest id, a null id last."""
    found = bbit_minhash.near_duplicates(rows, "__row").where(F.col("n_shingles") > 0)
    found = stored(found.select(F.col("doc_id").alias("__row"), "component_id"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"].alias("__row")
    kept = found.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(first)
    return found.join(kept, "__row", "left_anti").select(F.col("__row").alias("__dropped"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_text_batches(spark)
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    dropped = stored_alone(lambda: near_copies(rows), "dropped")
    return rows.join(dropped, rows["__row"] == dropped["__dropped"], "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Equal texts hold the same items, so the text's digest is key enough.
    rows = docs.withColumn("__text", F.sha2(F.coalesce("text", F.lit("")), 256))
    return decontaminate.without_leaks(rows, table(spark, sf_dir, "benchmark"), "__text").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto_mix.repeated(pareto_mix.mix_sources(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_text_batches(spark)
    return pfor_blocks.read_documents(pfor_blocks.write_ids(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# Language prediction, tokens and the file format are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
