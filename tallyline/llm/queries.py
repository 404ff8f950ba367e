"""One query for each operator, over the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (anchors, classlm, collocations, divergence, language, packing, personal, phrases, repair, speculative,
                           substrings, toxicity, transducer)
from tallyline.llm.texts import documents, remainder


def op1_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rest = remainder("doc_id", 4)
    network, languages = language.fit(language.sample(docs, rest != 2))
    return language.identify(docs, network, languages, keep=["doc_id"]).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(documents(spark, sf_dir))


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return personal.digest(docs, personal.learn(docs), keep=["doc_id"])


def op4_word_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rest = remainder("doc_id", 3)
    model = toxicity.fit(toxicity.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rest != 1))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op5_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = remainder("doc_id", 5)
    return classlm.scores(documents(spark, sf_dir), rest != 1).select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.near_duplicates(documents(spark, sf_dir))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speculative.digest(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


def op11_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op12_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {
    "op1_byte_language": op1_byte_language,
    "op2_recompression": op2_recompression,
    "op3_weak_supervision": op3_weak_supervision,
    "op4_word_convolution": op4_word_convolution,
    "op5_brown_classes": op5_brown_classes,
    "op6_token_counts": op6_token_counts,
    "op7_positional_index": op7_positional_index,
    "op8_divergence": op8_divergence,
    "op9_simhash_anchors": op9_simhash_anchors,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_certified_packing": op11_certified_packing,
    "op12_hirschberg_repair": op12_hirschberg_repair,
    "op13_trie_collocations": op13_trie_collocations,
}
