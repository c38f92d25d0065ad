"""From drift and quality audits to retraining decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline import constants as C
from plumbline.functions import reasons
from plumbline.operators.metrics import metric_record
from plumbline.operators.expectations import require_columns

WINDOW_KEYS = ("dataset", "window_id", "scenario")
METRICS = ("accuracy", "f1", "roc_auc", "pr_auc", "brier", "ece", "expected_cost")


def reference_metrics(scored: DataFrame) -> DataFrame:
    """Baseline record per (dataset, model_variant) of scored reference rows."""
    return metric_record(scored, ["dataset", "model_variant"]).select("dataset", "model_variant", *METRICS)


def quality_audit(scored_windows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Metrics per window and model with their change against the baseline."""
    keys = [*WINDOW_KEYS, "model_variant"]
    record = metric_record(scored_windows, keys)
    base = baseline.select(
        "dataset",
        "model_variant",
        F.col("f1").alias("base_f1"),
        F.col("expected_cost").alias("base_cost"),
    )
    return (
        record.join(base, ["dataset", "model_variant"])
        .withColumns(
            {
                "delta_f1_vs_reference": F.col("f1") - F.col("base_f1"),
                "delta_cost_vs_reference": F.col("expected_cost") - F.col("base_cost"),
            }
        )
        .select(*C.QUALITY_COLUMNS)
    )


def drift_share(drift_audit: DataFrame) -> DataFrame:
    """Share of flagged features per window."""
    return drift_audit.groupBy(*WINDOW_KEYS).agg(
        F.avg(F.col("drift_flag").cast("double")).alias("drift_feature_share")
    )


def worst_case(quality: DataFrame) -> DataFrame:
    """Most pessimistic change over the models of each window."""
    return quality.groupBy(*WINDOW_KEYS).agg(
        F.min("delta_f1_vs_reference").alias("delta_f1_vs_reference"),
        F.max("delta_cost_vs_reference").alias("delta_cost_vs_reference"),
    )


def with_action(
    signals: DataFrame,
    share: float = C.DRIFT_SHARE,
    f1_drop: float = C.RETRAIN_F1_DROP,
    cost_increase: float = C.RETRAIN_COST_INCREASE,
) -> DataFrame:
    """Add policy_action and trigger_reason; all three limits are inclusive."""
    rules = [
        ("drift_share", F.col("drift_feature_share") >= share),
        ("f1_drop", F.col("delta_f1_vs_reference") <= -abs(f1_drop)),
        ("cost_increase", F.col("delta_cost_vs_reference") >= abs(cost_increase)),
    ]
    reason = reasons(rules, "no_trigger")
    action = F.when(reason == "no_trigger", F.lit("observe")).otherwise(F.lit("retrain"))
    return signals.withColumns({"trigger_reason": reason, "policy_action": action})


def retraining_decisions(
    drift_audit: DataFrame,
    quality: DataFrame,
    share: float = C.DRIFT_SHARE,
    f1_drop: float = C.RETRAIN_F1_DROP,
    cost_increase: float = C.RETRAIN_COST_INCREASE,
) -> DataFrame:
    """One decision per window from both audits."""
    require_columns(drift_audit, [*WINDOW_KEYS, "drift_flag"], "drift audit")
    require_columns(
        quality, [*WINDOW_KEYS, "delta_f1_vs_reference", "delta_cost_vs_reference"], "quality audit"
    )
    signals = drift_share(drift_audit).join(worst_case(quality), list(WINDOW_KEYS), "inner")
    return with_action(signals, share, f1_drop, cost_increase).select(*C.DECISION_COLUMNS)


def scenario_summary(drift_audit: DataFrame, quality: DataFrame) -> DataFrame:
    """Drift share beside the worst cost change of each window."""
    cost = quality.groupBy(*WINDOW_KEYS).agg(
        F.max("delta_cost_vs_reference").alias("max_delta_cost_vs_reference")
    )
    return drift_share(drift_audit).join(cost, list(WINDOW_KEYS), "inner")


def retrain_gain(comparison: DataFrame) -> DataFrame:
    """What retraining bought: F1 gained and cost saved per scenario."""

    def at(phase: str, metric: str):
        return F.max(F.when(F.col("phase") == phase, F.col(metric)))

    return comparison.groupBy("dataset", "scenario").agg(
        (at("after_retrain", "f1") - at("before_retrain", "f1")).alias("f1_gain"),
        (at("before_retrain", "expected_cost") - at("after_retrain", "expected_cost")).alias("cost_saving"),
    )
