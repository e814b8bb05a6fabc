"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from isotherm.llm import conversations, gnat, language, mixing, pages, piece_codec, quality, simhash, site_quality, token_counts, token_store, vptree, warc
from isotherm.llm.batches import table
from isotherm.sources.scratch import new_folder


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"), with_text=False)


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        keep=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op3_nearest_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"), width=4, budget=4)


def op5_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


def op7_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20, relax=1.0)


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2
    )
    return token_store.read_tokens(spark, folder, with_ids=False)


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.site_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host="source", path="lang"
    )


def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_conversations(table(spark, sf_dir, "conversations"), planted=True)


def op12_hyperplane_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).drop("url")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_piece_codec": op2_piece_codec,
    "op3_nearest_url": op3_nearest_url,
    "op4_simhash_trie": op4_simhash_trie,
    "op5_entropy_mixing": op5_entropy_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_vantage_points": op7_vantage_points,
    "op8_language_crf": op8_language_crf,
    "op9_token_store": op9_token_store,
    "op10_site_quality": op10_site_quality,
    "op11_four_russians": op11_four_russians,
    "op12_hyperplane_tree": op12_hyperplane_tree,
    "op13_warc_dictionary": op13_warc_dictionary,
}
