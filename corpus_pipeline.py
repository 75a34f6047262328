"""From raw documents to packed training sequences, in four stages.

Each stage reads what the one before it wrote. The first three return the columns of
documents for the rows that they keep; the last returns the packed pieces. Rows are
kept or dropped by what their own text says: a null text counts as empty, and rows
that repeat an id are judged each for itself. Of a group of near-duplicates the row
with the smallest id stays, one row even if the id is repeated. Where labels say nothing
that tells documents apart, the two classifiers keep all documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqmill.llm import packing, quality_model, simhash, toxicity
from reqmill.llm.base import remainder, stored, table

TOXIC = 0.5  # documents with this score or more go
QUALITY = 0.7  # documents below this score go


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return toxicity.score(whole, model, keep=("doc",)).where(F.col("score") < TOXIC).select("doc.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 4) != 2)
    if not isinstance(model, quality_model.Model):  # nothing could be learned
        return docs
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return quality_model.score_texts(whole, model, keep=("doc",)).where(F.col("score") >= QUALITY).select("doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By the operator's own shingle length and bit distance."""
    return simhash.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", not_toxic), ("quality", good_quality), ("near_duplicates", one_of_each_group), ("packing", packed)]
ORACLE_SQL = None  # the classifiers are fitted, which SQL can't express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents, each stage written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
