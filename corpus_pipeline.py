"""A training corpus from raw documents, stage by stage.

Each stage is one of the training-data operators with its decisions carried out on all that its
predecessor kept. ``STAGES`` are (name, function); a function takes the session, the documents so
far and the folder of the tables, and returns a DataFrame, which is written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf.llm import bpe, line_runs, mixture, shared, simhash, toxicity

#: A document is rejected from this score on.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the limit; learned from the labelled rows of ``documents``."""
    shared.ready(spark)
    labels = shared.table(spark, sf_dir, "labels")
    learn = toxicity.learnable(F.col("doc_id"))
    names = docs.columns
    return toxicity.scored(docs, labels, learn).where(F.col("score") < TOXIC).select(*names)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that 10 or more of them hold; n_chars follows the text."""
    shared.ready(spark)
    names = docs.columns
    cleaned = line_runs.drop_frequent_lines(docs, least_docs=10)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned.select(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    shared.ready(spark)
    return simhash.kept(docs, width=5, rule=simhash.SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    shared.ready(spark)
    return mixture.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests that show that decoding gives the text back."""
    shared.ready(spark)
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(docs, ranks, pattern)
    decoded = bpe.decode(encoded, ranks, pattern)
    return decoded.select(
        "doc_id", "n_tokens", "ids", bpe.sha256_of("ids").alias("ids_sha256"), bpe.sha256_of("decoded").alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_frequent_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]

#: A trained classifier, fingerprints and tokens have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the cluster's shared folder and read again."""
    docs = shared.table(spark, sf_dir, "documents")
    scratch = shared.Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
