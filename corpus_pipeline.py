"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``docs``, whatever they are called beside ``doc_id`` and ``text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load, staged
from tablesync.llm.decontaminate import decontamination_stage
from tablesync.llm.language_id import language_stage
from tablesync.llm.near_dedup import near_duplicates
from tablesync.llm.packing import pack_documents
from tablesync.llm.pii_terms import pii_stage

#: Near-duplicates in the pipeline: five words, a similarity of 0.8 or more.
NEAR_PERCENT = 80


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; rows without an id stay."""
    gone = near_duplicates(docs, NEAR_PERCENT).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("__gone"), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, each with its sequence and offset."""
    return pack_documents(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", pii_stage),
    ("packing", packing_stage),
]

#: No SQL: the stages learn models, hash, embed or tokenise. Each is tested against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
