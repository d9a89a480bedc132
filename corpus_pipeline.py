"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import catalog, decontam, ngram_join, packing, pseudonyms, quality
from docspark.sources.scratch import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on those with labels, takes for good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.grades_of_labels(labels))
    return quality.score(docs, model).where(F.col("tail_probability") >= quality.KEEP).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at a similarity of 0.8 on five-word shingles connect."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pseudonyms.pseudonymise(docs, catalog.KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, catalog.tokenizer_file(), special=True)


STAGES = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_benchmark),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

#: The stages train, tokenise and permute, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
