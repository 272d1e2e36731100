"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return rows of ``docs`` with all its columns. A stage works on
everything that the one before it kept, whose result is written as Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from brightledger.llm.common import settle, table, vocabulary

#: Documents with a lower probability of good quality go.
LEAST_QUALITY = 0.5
#: Pieces of text a worker keeps the ids of: the executors still hold the memory of the other stages.
MEMO = 250_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents and keep those that score as good.

    Without labels of both kinds nothing tells good documents from others, and all stay. Null and empty texts score by the bias; equal texts score alike.
    """
    model = quality.learn(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.accepted(docs, model, LEAST_QUALITY) if model.informed else docs


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of at least 0.8."""
    return near_dedup.deduplicate(docs, shingle=5, percent=80)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids with their checksums."""
    return packing.checked(packing.pack(docs, vocabulary("byte_bpe_50k.json"), memo=MEMO))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", keep_distinct),
    ("near dedup", keep_one_of_near),
    ("decontamination", keep_clean),
    ("packing", pack),
]

# The classifier's weights and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
