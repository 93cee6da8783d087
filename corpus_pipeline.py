"""The corpus pipeline: documents to a mixed, deduplicated and tokenised training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return documents' columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nestwork.llm import bagminhash, line_dedup, mixing, quality, sentencepiece_trie
from nestwork.llm.common import written
from nestwork.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are robust outliers of their language and source go (operator 8)."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated across documents stay in the first one only (operator 6)."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays (operator 9)."""
    return bagminhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to the target weights of their sources and shuffled (operator 7)."""
    return mixing.mix_sources(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids (operator 1)."""
    ids = docs.select("doc_id", "lang", "source", "text")
    return sentencepiece_trie.encode(ids, sentencepiece_trie.default_model())


STAGES = [("quality rules", quality_rules), ("line dedup", drop_repeated_lines), ("near dedup", drop_near_copies),
          ("mixing", mix), ("tokenize", tokenize)]

#: SQL cannot express the near-copy and tokenizer stages; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{n}")
    return docs
