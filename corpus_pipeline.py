"""The corpus pipeline: filters, deduplicates and tokenises ``documents``.

Each stage takes what the one before kept, written as Parquet, so a lost executor
or a failed stage costs that stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mercantil.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from mercantil.llm.common import documents, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents scored as toxic go; all others stay."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one row of each group of equal texts stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each class of near copies, the row with the smallest id stays."""
    return jaccard_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the ids of each document."""
    return byte_bpe.bpe_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", clean_language), ("exact dedup", exact), ("near duplicates", near),
          ("decontamination", decontaminated), ("byte-level BPE", tokens)]

#: Alignment and learned scores are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
