"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearyard.llm import (
    decontam, kneser_ney, lang_id, line_dedup, lm_score, merkle, mixing, periodic_runs, piece_codec, near_dup, quality_rules, sharding, suffix_dedup,
)
from gearyard.llm.common import crc_remainder, documents


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_items(documents(spark, sf_dir), items)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id").distinct()
    few = good.limit(1_000_001).count() <= 1_000_000  # some 16 MB; more labels join by shuffle
    good = good.withColumn("good", F.lit(True))
    docs = documents(spark, sf_dir).join(F.broadcast(good) if few else good, "doc_id", "left")
    return kneser_ney.perplexities(docs, F.col("good"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "shard")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text")).drop("kept")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = lm_score.score(docs, crc_remainder(F.col("doc_id"), 7) != 2)
    return scored.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = lang_id.train(docs, ~held_out)
    return lang_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.take(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = near_dup.classes(documents(spark, sf_dir).select("doc_id", "text"))
    return told.select("doc_id", "class_id")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = piece_codec.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return piece_codec.digests(encoded)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(documents(spark, sf_dir).select("doc_id", "text"), planted=True)
    return periodic_runs.digests(found)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    told = merkle.manifest(docs, merkle.tampered(F.col("doc_id")))
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_lang_id": op8_lang_id,
    "op9_mixing": op9_mixing,
    "op10_near_dup": op10_near_dup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}
