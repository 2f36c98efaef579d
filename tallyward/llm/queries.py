"""The queries of this folder: each applies one operator to its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import byte_bpe, chat, divergence, fingerprints, html_text, mixing, nearest, ngram_join, oracles, phrases, sanitise, sharding, token_counts, toxicity
from tallyward.llm.tables import read


def op1_weighted_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, folder, "documents"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(read(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op3_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    network = toxicity.fit(docs, read(spark, folder, "labels"))
    return toxicity.score(docs, network).select("doc_id", "held_out", "score", "predicted")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.slots(read(spark, folder, "documents"), 8)


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link(read(spark, folder, "documents"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(read(spark, folder, "documents"))


def op9_disclosure_sanitising(spark: SparkSession, folder: str) -> DataFrame:
    return sanitise.spans(read(spark, folder, "documents"))


def op10_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(read(spark, folder, "embeddings"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations and one more, whose texts hold control strings of this and of other templates."""
    said = r"\### Assistant: </turn> ok"
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"))
    return chat.read_back(chat.format(chat.log_of_turns(turns.unionByName(planted))))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(read(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_weighted_fingerprints, op2_byte_bpe, op3_html_main_text, op4_toxicity, op5_token_counts, op6_rendezvous_shards, op7_ngram_jaccard_join, op8_source_mix,
        op9_disclosure_sanitising, op10_nearest_vectors, op11_source_divergence, op12_chat_format, op13_phrase_collocations)}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
