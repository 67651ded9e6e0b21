"""Registered queries of the package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from gradeloom.llm import (
    bbit_minhash,
    collocations,
    context_mix,
    decontaminate,
    ftrl_toxicity,
    hyper_lang,
    license_digest,
    nra_topk,
    pareto_mix,
    pfor_blocks,
    secret_links,
    token_align,
    weak_labels,
)
from gradeloom.llm.common import crc_mod, table

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto_mix.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.digest(secret_links.scan_secrets(table(spark, sf_dir, "documents")))


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_pfor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = pfor_blocks.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pfor_blocks.read_documents(manifest)


def op6_hyper_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 5) == 0
    found = hyper_lang.identify(docs, ~held_out, keep=["doc_id"])
    return found.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan_licenses(table(spark, sf_dir, "documents"))


def op9_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"))


def op10_context_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mix.score_documents(table(spark, sf_dir, "documents"), crc_mod("doc_id", 10) == 0)


def op11_lead_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return token_align.align(table(spark, sf_dir, "documents"), *files)


def op13_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ftrl_toxicity.score_toxicity(docs, labels, crc_mod("doc_id", 4) == 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nra_topk": op1_nra_topk,
    "op2_pareto_mix": op2_pareto_mix,
    "op3_secret_links": op3_secret_links,
    "op4_bbit_minhash": op4_bbit_minhash,
    "op5_pfor_blocks": op5_pfor_blocks,
    "op6_hyper_lang": op6_hyper_lang,
    "op7_decontaminate": op7_decontaminate,
    "op8_license_digest": op8_license_digest,
    "op9_weak_labels": op9_weak_labels,
    "op10_context_mix": op10_context_mix,
    "op11_lead_rollup": op11_lead_rollup,
    "op12_token_align": op12_token_align,
    "op13_ftrl_toxicity": op13_ftrl_toxicity,
}
