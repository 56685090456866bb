"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes the Parquet rows that its predecessor kept and returns a DataFrame; all but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, langid, neardups, packing, repeats
from millrace.llm.common import written

ORACLE_SQL = None  # fingerprints, filters and token ids are not SQL; tests hold each stage against brute force


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without text or without a letter go."""
    model = langid.fit(docs)
    told = langid.identify(docs, model, lang="_told", score="_sure")
    return told.where(F.col("_told") != langid.UNKNOWN).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word Jaccard of 0.8 or more) stays: the one with the smallest id."""
    return neardups.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document keeps are cut out; documents of which nothing is left go."""
    return repeats.without_repeats(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their places in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_test_items),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
