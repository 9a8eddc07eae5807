"""From raw documents to token files: five stages, each one operator.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and is written as Parquet before the next one reads it. The first four
return the columns of ``docs``; the last returns a row per document of the
token files, in which a document that the mix took twice has two.

Null texts, repeated rows and extra columns are treated as each operator's
docstring says; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.common import stored, table
from cadenza.llm.decontaminate import drop_contaminated
from cadenza.llm.mixing import mixed_documents
from cadenza.llm.near_dedup import drop_near_duplicates
from cadenza.llm.token_files import encode_and_read
from cadenza.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Python workers keep what earlier stages imported: a small cache leaves room for that.
    return encode_and_read(docs, cache_words=1 << 15)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# Learned scores, hashed permutations and tokenisation have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
