"""The training-data pipeline: five stages over the documents table.

Each stage is a function of (spark, docs, sf_dir) that works on all its
predecessor kept and returns a DataFrame, written as Parquet and reread as the
next one's ``docs``.  All but the last return the columns of documents:

1. quality classifier - documents with P(grade >= 1) under 0.5 go;
2. near duplicates - one document of each class of the shingle join stays;
3. decontamination - documents with a benchmark window go;
4. secret scan - every span found is replaced by a mark (n_chars follows);
5. mix - words each document gives to the mix, by source targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brisa.llm import chosen_path, mixing, ordinal, phrase_index, secrets
from brisa.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrase_index.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mix", mix),
]

#: The stages are not expressible in SQL (trained classifier); tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of what the stages keep of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
