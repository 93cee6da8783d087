"""Registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nestwork.sources.tables import table

from . import (bagminhash, chat_format, language_id, line_dedup, mixing, prefix_trie, quality, secret_scan,
               sentencepiece_trie, sharding, structure_repair, voronoi_knn, warc)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_trie.token_table(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_table(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_table(spark, table(spark, sf_dir, "conversations"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_table(spark, table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_table(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_dup_table(table(spark, sf_dir, "documents"))


def op10_exact_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.knn_table(table(spark, sf_dir, "embeddings"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_table(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_table(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_secrets, op3_chat_format, op4_sharding, op5_warc, op6_line_dedup, op7_mixing, op8_quality,
    op9_near_dedup, op10_exact_knn, op11_language_id, op12_prefix_trie, op13_structure_repair)}

ORACLE = {"op3_chat_format": chat_format.ORACLE, "op5_warc": warc.ORACLE, "op6_line_dedup": line_dedup.ORACLE,
          "op7_mixing": mixing.ORACLE, "op10_exact_knn": voronoi_knn.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE,
          "op13_structure_repair": structure_repair.ORACLE}
