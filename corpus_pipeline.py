"""The training-corpus pipeline: documents in, packed sequences out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame and works on all that
its predecessor kept. ``run`` writes every stage's rows to the shared folder and
hands the reread table to the next one, so a lost executor repeats one stage at
most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import exact, packing, simhash, suffixes
from tallyloom.llm import toxicity as toxic
from tallyloom.llm.common import stored
from tallyloom.llm.queries import vocabulary


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model, learned from the labels that are not held out, does not find toxic."""
    return toxic.accepted(docs, toxic.learn_without_held_out(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that SimHash fingerprints of three-word shingles at two or fewer differing bits connect, the one with the least doc_id."""
    return simhash.keep_one(docs, words=3, most=2)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that lie in any sequence of 50 words that starts more than once."""
    return suffixes.without_repeats(docs, width=50, gram=12, kind="words")


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing_)]

# Tokenizer, learned scores and XXH64 have no SQL form; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
