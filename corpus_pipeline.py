"""Documents to token ids: language, near duplicates, decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and decides on all that the stage before it kept. `run`
writes every stage's result as Parquet to the shared folder and rereads it for the next stage. No
SQL states the whole (the first stage is a trained model); tests hold each stage against a
brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontam, langid, pieces, simhash
from threadloom.llm.shared import shared_folder, table, unused_name, without

MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter, or null, go.

    Without any label there is no language to tell, and no document is rejected.
    """
    model = langid.train(docs)
    if not model.langs:
        return docs
    row = F.xxhash64("doc_id", "text")  # texts go to the model, but need not come back
    key = unused_name(docs)
    rejected = langid.predict(docs.select(row.alias(key), "text"), model).where(
        F.col("lang_pred") == langid.UNDETERMINED).select(key)
    return without(docs.withColumn(key, row), rejected, key).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id.

    Linked are documents whose fingerprints of three-word shingles differ in three bits or fewer.
    """
    return simhash.keep_one(docs, words=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item (all words of a shorter one)."""
    row = F.xxhash64("doc_id", "text")  # also tells rows without doc_id, or of one doc_id, apart
    hit = decontam.contamination(
        docs.select(row.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    key = unused_name(docs)
    hit = hit.where(F.size("positions") > 0).select(F.col("doc_id").alias(key))
    return without(docs.withColumn(key, row), hit, key).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their number and digest, and the digest of the decoded text."""
    return pieces.document_digests(docs, public_tokenizers.path(MODEL), with_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
