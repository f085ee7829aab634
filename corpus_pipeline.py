"""The corpus pipeline: quality, exact dedup, near-dedup, PII, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. The
library's subpackage holds the operators; this module only chains them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerosift.llm import exact_dedup, near_dedup, packing, pii, quality
from aerosift.llm.common import table, workers_import
from aerosift.session import materialize


def _keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows whose id has a positive decision (one per id); a null id counts as an id."""
    keep = decisions.select(F.col("doc_id").alias("_keep_id")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_keep_id"]), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    workers_import(spark)
    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    return _keep(docs, scores.where("predicted = 1"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    workers_import(spark)
    return _keep(docs, exact_dedup.exact_dedup(docs).where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays."""
    workers_import(spark)
    return _keep(docs, near_dedup.near_dedup(docs).where("kept"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and slot."""
    workers_import(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Learned stages have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
