"""Documents to training tokens: five stages, each an operator of ``tallyward.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.

A null text counts as an empty one: it is no near copy, holds no personal data and takes no part in the mix. Rows without
an id are kept as rows of their own; rows alike in id and text count once. A null lang or source is a value like any
other. Other columns pass through the stages, whatever their names. An empty table gives an empty result.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import byte_bpe, mixing, ngram_join, sanitise, toxicity
from tallyward.llm.tables import read, stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the network rejects; it learns from the labels of these documents."""
    network = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    return toxicity.score(kept, network).filter("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked ones, that with the smallest id."""
    return ngram_join.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Generalises personal data and removes the words that give it away; ``n_chars`` follows the text."""
    return sanitise.sanitise(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that their sources have the target shares."""
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the digests that tell whether they decode to its text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(docs, path, public_tokenizers.PATTERN, ids=True).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", toxic), ("near-duplicates", near_duplicates), ("personal-data", personal_data), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None  # a trained network decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
