"""The operators bound to the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, near_dup, packing, quality, repair, sharding, suffix_dedup, token_counts, toxicity, urls
from . import whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_chat(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    # Fixed values of the contract.
    said = "</s>[INST] ok [/INST]"
    tried = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.digests(chat.format_chats(turns.unionByName(tried)))


ORACLE["op2_chat"] = chat.DIGESTS_SQL


@query
def op3_byte_bpe(spark, sf):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op4_nearest(spark, sf):
    return ann.nearest(table(spark, sf, "embeddings"))


@query
def op5_near_dup(spark, sf):
    return near_dup.classes(table(spark, sf, "documents"))


@query
def op6_urls(spark, sf):
    return urls.filter_urls(table(spark, sf, "pages"))


ORACLE["op6_urls"] = urls.URLS_SQL


@query
def op7_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_sharding(spark, sf):
    return sharding.shard_documents(table(spark, sf, "documents"))


@query
def op9_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.judge(docs, bands=quality.fit_bands(docs, table(spark, sf, "labels")))


@query
def op10_suffix_dedup(spark, sf):
    # Passages of over 50 words may be shorter than 400 bytes: the text that is left goes by both rules.
    return suffix_dedup.removal_digests(table(spark, sf, "documents"), words=51)


@query
def op11_repair(spark, sf):
    return repair.repair_digests(table(spark, sf, "conversations"))


@query
def op12_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op13_whitening(spark, sf):
    return whitening.whitened_components(table(spark, sf, "embeddings"))
