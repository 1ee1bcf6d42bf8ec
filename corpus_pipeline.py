"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, documents, folder of the tables) and returns the documents that it keeps, with
the columns of ``documents``; the last one returns the pieces of the packed sequences.  Between stages
the rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plinth.llm import exact_dedup, near_dedup, packing, quality, toxicity
from plinth.llm.graph import written
from plinth.llm.text import worker_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or fall below the likelihood-ratio threshold go."""
    worker_path(spark)
    return quality.kept_documents(docs, _labels(spark, sf_dir))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose matched clauses make them toxic go; the model learns from what the stage is given."""
    worker_path(spark)
    return toxicity.kept_documents(docs, toxicity.fit(docs, _labels(spark, sf_dir)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    return exact_dedup.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 on five-word shingles the smallest doc_id stays."""
    worker_path(spark)
    return near_dedup.kept_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    worker_path(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("packing", packed_sequences),
]

#: Learned thresholds, MinHash candidates and retrieval have no SQL form; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
