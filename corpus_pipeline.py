"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result as Parquet to the shared
folder and reads it back as the next one's docs, so a lost executor never costs more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from journeyloom.llm.catalogue import tokenizer_files
from journeyloom.llm.decontaminate import without_leaks
from journeyloom.llm.jaccard import without_near_duplicates
from journeyloom.llm.packing import pack_along_curve
from journeyloom.llm.substring import cut_repeats
from journeyloom.llm.toxicity import without_toxic
from journeyloom.session import fresh_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word runs that a document with a smaller id has."""
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences along the Hilbert curve, with their ids and the ids' crc32."""
    return pack_along_curve(docs, *tokenizer_files(), length=1024, values=("ids", "ids_crc32"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages learn models and cut texts by rules that SQL cannot express; tests/llm/test_pipeline.py checks them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
