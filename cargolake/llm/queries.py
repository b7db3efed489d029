"""The registered queries of the operators, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolake.llm import (
    conversations, divergence, fingerprints, host_quality, language, licenses, merge_dropout, near_dedup, packing, simhash,
    substring_dedup, token_store, toxicity,
)
from cargolake.llm.base import crc_of_id, documents, labels

Query = Callable[[SparkSession, str], DataFrame]


def op1_min_max_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=3, share=0.85)


def op2_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model, ["doc_id", held_out.alias("held_out")])


def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return host_quality.judge(documents(spark, sf_dir), host="source", carry=["doc_id"]).select(
        "doc_id", q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"],
        q["failed_base"].alias("base_failed"), q["kept"],
    ).toDF("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_tokens(documents(spark, sf_dir), end_id=0)
    return token_store.read_documents(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op5_fm_index_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), window=35)
    return found.select(
        "doc_id", "repeats.n_words", "repeats.n_removed",
        F.sha2(F.col("repeats.kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op6_merge_dropout_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_md5 = F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    made = merge_dropout.round_trip(documents(spark, sf_dir), seed=17, dropout=0.1, keep=["doc_id", text_md5])
    return made.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        (F.md5("decoded") == F.col("text_md5")).alias("lossless"),
    )


def op7_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, marks = documents(spark, sf_dir), labels(spark, sf_dir)
    held_out = crc_of_id(F.col("doc_id")) % 5 == 0
    model = toxicity.fit(toxicity.labelled(docs, marks, train=~held_out))
    scored = toxicity.score(docs, model, ["doc_id", held_out.alias("held_out")])
    return scored.select(
        "doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(documents(spark, sf_dir), capacity=1024, end_id=2)


def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op11_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(documents(spark, sf_dir), words=3)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.report(conversations.repair(conversations.damaged(rows)))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_min_max_near_dedup, op2_word_backoff_language, op3_host_quality, op4_wavelet_tokens, op5_fm_index_substrings,
    op6_merge_dropout_pieces, op7_clause_toxicity, op8_license_scan, op9_best_fit_packing, op10_weighted_fingerprints,
    op11_simhash_multi_index, op12_source_divergence, op13_conversation_repair,
)}
SQL: dict[str, str] = {"op3_host_quality": host_quality.ORACLE, "op12_source_divergence": divergence.ORACLE}
