"""Calibration audit tables and the choice of the calibrated variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from plumbline import constants as C
from plumbline.operators.metrics import metric_record

UNCALIBRATED = "uncalibrated"


def calibration_audit(scored: DataFrame) -> DataFrame:
    """One record per (dataset, model, variant, split) of scored rows."""
    keys = list(C.CALIBRATION_COLUMNS[:4])
    return metric_record(scored, keys).select(*C.CALIBRATION_COLUMNS)


def best_calibrated_variant(audit: DataFrame) -> DataFrame:
    """Per dataset the calibrated variant with the lowest Brier score.

    Ties fall to log_loss, ece, then name. The uncalibrated variant never wins.
    """
    order = W.partitionBy("dataset").orderBy("brier", "log_loss", "ece", "variant")
    return (
        audit.where(F.col("variant") != UNCALIBRATED)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") == 1)
        .drop("place")
    )


def calibration_comparison(audit: DataFrame) -> DataFrame:
    """Uncalibrated against the best variant: Brier and ECE side by side."""
    best = best_calibrated_variant(audit).select(
        "dataset",
        F.col("variant").alias("calibrated_best_source"),
        F.col("brier").alias("best_brier"),
        F.col("ece").alias("best_ece"),
    )
    plain = audit.where(F.col("variant") == UNCALIBRATED).select(
        "dataset", F.col("brier").alias("uncalibrated_brier"), F.col("ece").alias("uncalibrated_ece")
    )
    return best.join(plain, "dataset").select(
        "dataset",
        "calibrated_best_source",
        "uncalibrated_brier",
        "best_brier",
        "uncalibrated_ece",
        "best_ece",
    )


def two_candidates(scored: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of the uncalibrated and the best variant, the latter as `calibrated_best`."""
    best = best_calibrated_variant(audit).select("dataset", F.col("variant").alias("best"))
    joined = scored.join(best, "dataset")
    label = F.when(F.col("variant") == UNCALIBRATED, F.col("variant")).when(
        F.col("variant") == F.col("best"), F.lit("calibrated_best")
    )
    return joined.withColumn("variant", label).where(F.col("variant").isNotNull()).drop("best")
