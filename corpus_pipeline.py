"""Documents through language ID, deduplication, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spheremeans.config import new_path
from spheremeans.llm.exact_dedup import drop_duplicates
from spheremeans.llm.language_id import keep_known_language
from spheremeans.llm.mixing import mix_documents
from spheremeans.llm.near_dedup import drop_near_duplicates
from spheremeans.llm.packing import pack_documents


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found stay."""
    return keep_known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the smallest id."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", exact_dedup),
    ("near-dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
