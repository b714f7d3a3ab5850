"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the next stage's ``docs``, which is written as Parquet and read
again in between. All but the last keep the columns of ``documents``.

1. language_id: PPM language identification; a missing lang is filled, documents
   without a language (null, or no letter) go.
2. near_dedup: SuperMinHash near-duplicate groups on five-word shingles at 0.8;
   the document with the smallest id of each group stays.
3. repeated_bytes: bytes covered by a 200-byte string that also starts
   anywhere else are cut out; documents stay.
4. mixing: sources are mixed to their target weights; a document is a row per
   pass over its source that takes words of it, in the order of the schedule.
5. packing: documents are packed into sequences of at most 2048 tokens; one
   row per piece.

An empty table gives an empty result. Nulls, odd texts and repeated rows are
treated as each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import language_id, mixing, near_dedup, packing, repeated_bytes
from quarry.llm.common import Scratch, table
from quarry.llm.encode import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_of_each(docs, Scratch(spark, "near-dedup"))


def cut_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeated_bytes.without_repeats(docs, Scratch(spark, "repeated-bytes"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, Scratch(spark, "mixing"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("repeated_bytes", cut_repeated_bytes),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenization and language models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.write(docs, name)
            if i:
                scratch.drop(STAGES[i - 1][0])
    return docs
