"""Corpus pipeline: quality rules, language ID, near-dedup and packing of ``documents``.

Each stage takes (spark, docs, sf_dir); what it returns is the next stage's ``docs``.
All but the last return the columns of ``documents``, as they are, with any others that
the table has, whatever their names.  An empty table stays empty, repeated rows are
judged alike.
"""

from __future__ import annotations

import public_tokenizers

from tracequarry.lineage import discard, materialize
from tracequarry.llm import bpe, language_id, packing, quality, simhash


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go; null and empty texts fail the base rule, null ids and languages don't matter."""
    return quality.keep_good(docs)


def known_language(spark, docs, sf_dir):
    """Documents in which no learned language is recognised go, as do texts without a letter; all stay if no row has a language."""
    return language_id.keep_known(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, the one with the smallest id, one with a null id only if all have none.

    Null, empty and blank texts share fingerprint 0, so one of them stays."""
    return simhash.keep_first(docs)


def pack(spark, docs, sf_dir):
    """All that is left, in sequences of 2048 tokens; null texts are empty and get the end id alone, very long ones are cut."""
    return packing.pack(docs, bpe.read_model(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", known_language),
    ("SimHash near-dedup", near_dedup),
    ("best-fit packing", pack),
]

#: SQL can express neither the language machines nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; each stage's rows are written once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), name.split()[0])
        discard(docs)  # the table itself is no intermediate and stays
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
