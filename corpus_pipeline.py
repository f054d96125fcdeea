"""From raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last keep the columns
of ``documents``. What a stage returns is written and read again as the documents of the next.

1. ``quality`` drops documents that the classifier rejects. It learns from labelled documents that
   are not held out.
2. ``near_duplicates`` keeps one document of each group of near-duplicates.
3. ``repeats`` cuts strings of 100 bytes that occurred before.
4. ``mixture`` repeats or drops documents so that the sources come near their weights.
5. ``sequences`` packs the tokens of what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spindrift.llm import language, mixing, packing, quality, simhash, suffix_dedup
from spindrift.llm.shared import written


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.learn(docs, labels.where(~language.held_out("doc_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", accept),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixture", mixture),
    ("sequences", sequences),
]
#: SQL cannot express the learned and the tokenised stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
