"""From raw documents to packed training sequences.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the
next stage's documents. Every stage but the last keeps the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.decontaminate import decontaminate
from plumbline.llm.neardup import drop_near_duplicates
from plumbline.llm.packing import packed_documents, tokenizer_path
from plumbline.llm.quality import KEEP, learn, with_quality
from plumbline.llm.secrets import redact_secrets
from plumbline.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, takes for good ones."""
    model = learn(docs, _table(spark, sf_dir, "labels"))
    return with_quality(docs, model, column="_score").where(F.col("_score") >= KEEP).drop("_score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and linked credentials replaced by a mark."""
    clean = redact_secrets(docs)
    changed = {"n_chars": F.length("text").cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {}
    return clean.withColumns(changed)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenized documents with their sequence and place."""
    return packed_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

# A learned classifier, sampling and tokenizing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
