"""Corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages,
source mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents``.

Defined results for odd rows: a null text is an empty text and passes every
filter; rows with a null id are never named as copies and lose no passages;
repeated rows are one document's copies to the near-duplicate stage, which keeps
the rows of the smallest id; extra columns travel along untouched; an empty
table passes through empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockhouse.llm import mixing, ngram_join, packing, substring, toxicity
from blockhouse.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7; learns from labels of two thirds of the ids."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: the smallest id."""
    return ngram_join.one_of_each_group(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 20 words that start earlier; n_chars follows the text."""
    out = substring.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Flatter source shares: the largest source is read once, no source more than
    1.25 times as often, so that no document is lost to the mixture."""
    return mixing.mixed_documents(docs, entropy_gain=1.0, max_repeat=1.25, keep_all=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens placed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# SQL can express neither the learned scores nor the tokenizer: tests/llm compares
# run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
