"""From documents to training sequences: quality rules, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import near_dup, packing, quality, suffix_dedup
from tidewire.llm.common import table
from tidewire.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands, which are learned from those labelled good."""
    return quality.keep_good(docs, quality.fit_bands(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without what lies in a passage of over 50 words, or in a 400-byte string, which occurs again.

    No byte length stands for 50 words: they may have 101 bytes or thousands. Texts with few blanks need the bytes.
    """
    return suffix_dedup.remove_repeated(docs, words=51)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed_sequences),
]
# SQL can express neither the compression nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
