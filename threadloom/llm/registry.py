"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from threadloom.llm import (
    aligning, ann, arrow_ids, decontam, hilbert, langid, ngram_join, pieces, ranking, simhash,
    urls, warc, wrapper)
from threadloom.llm.oracle import ORACLE  # noqa: F401
from threadloom.llm.shared import shared_folder, table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hilbert_shards(spark, sf_dir):
    return hilbert.document_shards(table(spark, sf_dir, "documents"))


@query
def op3_url_models(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op5_simhash_components(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_word_first_language(spark, sf_dir):
    return langid.language_of(table(spark, sf_dir, "documents"))


@query
def op7_benchmark_index(spark, sf_dir):
    return decontam.digest(decontam.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op8_warc_revisits(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.resolve_revisits(warc.read_archives(spark, folder)).drop("url")


@query
def op9_arrow_token_ids(spark, sf_dir):
    manifest = arrow_ids.write_sequences(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        shared_folder(spark, "token-ids"))
    return arrow_ids.document_digests(spark, manifest)


@query
def op10_sentencepiece_spans(spark, sf_dir):
    return pieces.document_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_wrapper_text(spark, sf_dir):
    return wrapper.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op2_learned_partitions(spark, sf_dir):
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op11_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@query
def op13_tokenizer_alignment(spark, sf_dir):
    return aligning.document_alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_best_position_search(spark, sf_dir):
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
