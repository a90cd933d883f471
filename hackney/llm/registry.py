"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import (alignment, htmltext, langid, linededup, minhash, oracle, packing, secrets, sharding, spcodec,
                         sphericalcaps, tokencount, topk, wordruns)
from hackney.llm.common import read

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spcodec.encode(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op3_no_random_access_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", topk.fixed_point(F.col("embedding")).alias("v"))
    return topk.top_k(rows.where(F.col("vec_id") % 50 == 0), rows, 5)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.learn(pages))


def op6_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sphericalcaps.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), words=2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = langid.learn(docs.where(~langid.held_out("doc_id")))
    return langid.identify(docs, profiles).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dropped_lines(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER),
                             public_tokenizers.path(PIECE_MODEL))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordruns.collapse(read(spark, sf_dir, "documents"), prepare=wordruns.planted)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_no_random_access_topk": op3_no_random_access_topk,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_spherical_caps": op6_spherical_caps,
    "op7_superminhash": op7_superminhash,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": sharding.oracle("doc_id", "documents", sharding.SHARDS, sharding.TABLE_SIZE),
    "op3_no_random_access_topk": oracle.TOP_K,
    "op6_spherical_caps": oracle.SPHERICAL_CAPS,
    "op7_superminhash": oracle.SUPERMINHASH,
}
