"""The registered queries: each applies its operator, with its production
parameters, to the whole of its table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import cross_polytope, hard_negatives, language_id, mixing, near_dedup, oracles, packing, pii, prefix_trie, repeated_bytes, token_counts, token_files, vantage_trees, warc
from quarry.llm.common import Scratch, table
from quarry.llm.encode import vocabulary


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def op2_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_trees.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Scratch(spark, "op2"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op4"), words=4)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op5")
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), scratch.path("warc"), scratch))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op6")
    manifest = token_files.write_ids(table(spark, sf_dir, "documents"), scratch.path("ids"),
                                     vocabulary("word_bpe_49k.json"), 2, scratch)
    return token_files.read_ids(manifest)


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op7"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents"), Scratch(spark, "op8")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op9")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"),
                                     scratch.path("cache"), scratch)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    found = hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, Scratch(spark, "op11"), label=moved)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op12")
    turns, conversations = prefix_trie.rebuilt(table(spark, sf_dir, "conversations"), scratch)
    return prefix_trie.trie(turns, conversations, scratch)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count_of(k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.as_text(patterns_only=True).cast("binary"), 256).alias("base_sha256"), pii.as_text().alias("spans"))


QUERIES = {f.__name__: f for f in (op1_repeated_bytes, op2_vantage_trees, op3_language_id, op4_near_dedup, op5_warc, op6_token_files, op7_cross_polytope, op8_mixing, op9_token_counts, op10_packing, op11_hard_negatives, op12_prefix_trie, op13_pii)}
ORACLE = {"op8_mixing": oracles.OP8, "op11_hard_negatives": oracles.OP11, "op12_prefix_trie": oracles.OP12}
