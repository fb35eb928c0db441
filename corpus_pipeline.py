"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import decontaminate, exact_dedup, langid, packing, simhash
from roadlens.llm.common import drop_table, reachable, table, write_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their fingerprints, the row with the smallest id stays."""
    return simhash.near_deduplicate(docs, shingle=3, max_distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark passages go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, with its length bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminated), ("packing", packed)]

#: The fingerprints of the near-dedup stage cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again, and dropped when its successor is written."""
    reachable(spark)
    docs, made = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
        if made is not None:
            drop_table(made)
        made = docs
    return STAGES[-1][1](spark, docs, sf_dir)
