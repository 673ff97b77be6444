"""Queries of the training-data operators over the contract tables."""

from __future__ import annotations

import public_tokenizers

from tracequarry.llm import (
    alignment,
    bpe,
    embedding_dedup,
    language_id,
    license_scan,
    lm_scoring,
    oracles,
    packing,
    prefix_trie,
    quality,
    quote_linking,
    sharding,
    simhash,
    word_transducer,
)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(_table(spark, sf_dir, "documents"), bpe.model_from_ranks(ranks, public_tokenizers.PATTERN))


def op2_collision_counting(spark, sf_dir):
    return embedding_dedup.cluster(_table(spark, sf_dir, "embeddings"))


def op3_cross_entropy_difference(spark, sf_dir):
    target = _table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scoring.score(_table(spark, sf_dir, "documents"), target)


def op4_language_id(spark, sf_dir):
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_quote_linking(spark, sf_dir):
    return quote_linking.link(_table(spark, sf_dir, "conversations"))


def quoted_conversations(spark, sf_dir):
    """Quotation linking over conversations whose turns quote earlier ones; ``conversations`` itself has no quotes."""
    return quote_linking.link(spark.sql(quote_linking.QUOTED.replace("conversations", "{talk}"), talk=_table(spark, sf_dir, "conversations")))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    model = bpe.read_model(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(_table(spark, sf_dir, "documents"), model)


def op8_jump_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op9_golay_simhash(spark, sf_dir):
    return simhash.cluster(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"))


def op11_pair_counts(spark, sf_dir):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = f.read()
    return alignment.align(_table(spark, sf_dir, "documents"), bpe.read_model(public_tokenizers.path("byte_bpe_50k.json")), pieces)


def op12_word_transducer(spark, sf_dir):
    return word_transducer.digests(_table(spark, sf_dir, "documents"), bpe.read_model(public_tokenizers.path("word_bpe_49k.json")))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_byte_bpe, op2_collision_counting, op3_cross_entropy_difference, op4_language_id, op5_quote_linking,
                                    op6_license_scan, op7_best_fit_packing, op8_jump_sharding, op9_golay_simhash, op10_quality_rules, op11_pair_counts, op12_word_transducer, op13_prefix_trie,
                                    quoted_conversations)}


def oracle_sql() -> dict:
    return oracles.oracle_sql()
