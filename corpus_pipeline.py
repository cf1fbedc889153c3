"""The training-data pipeline: five stages from documents to a mixed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import jaccard, mixing, quality, secrets, templates
from txnlake.llm.tables import load, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = quality.score(docs, quality.fit(docs, load(spark, sf_dir, "labels")))
    return scored.where(F.col("quality_score") >= quality.KEEP_AT).select(*COLUMNS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return jaccard.one_of_each(docs, jaccard.link_components(docs)).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return templates.without_contaminated(docs, load(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redacted(docs, secrets.fit(secrets.labelled(docs))).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that sources come near their target weights."""
    return mixing.replicated(docs, mixing.target_rates(docs)).select(*COLUMNS, "copy")


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
]

#: The first stage is a trained model, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
