"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.llm import (byte_bpe, collocations, credentials, language, licenses, nearest, negatives, packing, quality_model, quality_rules,
                         sharding, simhash, toxicity)
from reqmill.llm import oracles
from reqmill.llm.base import remainder, stored, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned outside the held-out fifth of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence sentences and the licences that they amount to."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("identifiers").cast("long").alias("n_sentences"),
        F.array_join("identifiers", ",").alias("identifiers"), F.array_join(F.sort_array("licences"), ",").alias("licences"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned outside the held-out fifth of the ids."""
    docs = table(spark, sf_dir, "documents")
    net = language.train(docs, remainder(F.col("doc_id"), 5) != 0)
    return language.predict(docs, net).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, failed rules, and the verdict of the policy."""
    recorded = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base, policy = quality_rules.Policy("base", 1, quality_rules.BASE), quality_rules.latest("prose")
    return recorded.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(base)).alias("base_failed"), quality_rules.passes(policy).alias("kept"), "failures")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate group."""
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    return sharding.place(table(spark, sf_dir, "documents"), "doc_id", sharding.names())


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in a sequence of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE).drop("ids")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded bytes."""
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, BYTE_RANKS).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned outside the held-out quarter of the ids."""
    stats = stored(quality_model.measured(table(spark, sf_dir, "documents")), "statistics")
    learn = remainder(F.col("doc_id"), 4) != 2
    model = quality_model.fit(stored(quality_model.labelled(stats, table(spark, sf_dir, "labels"), learn), "training"))
    return quality_model.score(stats, model).select(
        "doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector, against all vectors."""
    return nearest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector's positives, against all vectors."""
    id_of, label = F.col("vec_id"), F.col("label")
    rows = stored(negatives.members(table(spark, sf_dir, "embeddings"), id_of % 7 == 0, (label + 1) % 10), "members")
    return negatives.mine(rows, id_of % 100 == 0)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: the base patterns and values that are hard to guess."""
    return credentials.secrets(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_language": op3_language,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_model": op9_quality_model,
    "op10_nearest": op10_nearest,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_secrets": op12_secrets,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = oracles.ORACLES
