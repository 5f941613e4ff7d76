"""The corpus pipeline: from ``documents`` to a sharded training mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``. A stage's result is written and read again as
the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import free_name, stage_table
from tidelog.llm.decontam import decontaminate
from tidelog.llm.language_id import known_language
from tidelog.llm.mixing import mixed_documents
from tidelog.llm.near_dedup import drop_near_duplicates
from tidelog.llm.sharding import place


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those under the bound of their predicted language, where there are labels to learn from.

    Null and empty texts have no letter. Repeated rows and ties are judged alike."""
    return known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 80 % of its five-word shingles stays, the one with the smallest id.

    Texts without words and rows without id stay; of rows of one id one stays."""
    return drop_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % of the five-word shingles of a benchmark item go. Null and empty texts hold nothing and stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=5, least=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights: each document none, once or twice, in the order of the mix. Texts without words are not in it."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's slot and shard of 64; copies share theirs, rows without id are placed by all they hold."""
    return place(docs, 64, slot=free_name(docs, "slot"), shard=free_name(docs, "shard"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: SQL can't express the stages that learn; each stage has a test against a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
