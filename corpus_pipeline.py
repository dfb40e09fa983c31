"""The corpus pipeline: each stage reads what the one before has kept, from Parquet.

Quality rules and classifier drop what they reject, the Jaccard join leaves one document of each group, and packing
places the rest in training sequences. All stages but the last return the columns of ``documents``; the last returns one
row per packed piece. Null, empty, repeated and very long texts are handled as the operators say; an empty table gives an
empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import gam, jaccard_join, packing, quality_rules
from sparkmart.runtime import materialize


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the adaptive thresholds reject."""
    return quality_rules.filtered(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, trained on the labels of the documents it is given, scores below its threshold."""
    return gam.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave one document of each group of near duplicates, that with the smallest id."""
    return jaccard_join.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences; one row per piece."""
    return packing.packed(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("jaccard_join", duplicates_stage),
    ("best_fit_packing", packing_stage),
]

#: training a classifier and packing have no SQL counterpart
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
