"""From raw documents to packed training sequences, stage by stage.

Every stage but the last returns the columns of ``documents``; each works on all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.decontam import remove_contaminated
from ledgerloom.llm.neardup import keep_one
from ledgerloom.llm.packing import pack
from ledgerloom.llm.pii import mask_pii
from ledgerloom.llm.quality import keep_good
from ledgerloom.llm.tables import cut_lineage, read


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return keep_one(docs, shingle=5, percent=80)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    return mask_pii(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids into sequences of 2048."""
    return pack(docs)


STAGES = [
    ("quality classifier", good), ("minhash near-dedup", unique), ("benchmark decontamination", clean), ("pii", masked), ("packing", packed),
]
#: A trained classifier and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
