"""Default thresholds, costs and table contracts.

Fixed values: they must agree with published results, so they are stated here
once and imported everywhere else.
"""

SEED = 42
ALPHA = 0.05
PSI_WARN = 0.10
PSI_ALERT = 0.25
PSI_FLOOR = 1e-6
PSI_BINS = 10
ECE_BINS = 10
RETRAIN_F1_DROP = 0.05
RETRAIN_COST_INCREASE = 0.15
DRIFT_SHARE = 0.30
FP_COST = 1.0
FN_COST = 5.0
MIN_RECALL = 0.60
POSITIVE_SHARE = 0.75
REFERENCE_SHARE = 0.35
RETRAIN_TEST_SHARE = 0.40
MIN_WINDOW_SIZE = 40

SCENARIOS = ("stable", "covariate", "prior", "combined")

# Feature-score methods by family (fixed values).
FILTER_METHODS = ("VarianceThreshold", "Correlation", "MutualInfo", "ANOVA")
WRAPPER_METHODS = ("RFE", "SFS_forward", "L1_logreg", "RF_importance", "Permutation")

# Ordered column contracts of the audit tables (fixed values).
RANKING_COLUMNS = ("dataset", "method", "feature", "score", "rank")
DRIFT_COLUMNS = (
    "dataset", "window_id", "scenario", "feature", "feature_type",
    "detector", "statistic", "p_value", "effect_size", "drift_flag",
)
QUALITY_COLUMNS = (
    "dataset", "window_id", "scenario", "model_variant", "accuracy", "f1",
    "roc_auc", "pr_auc", "brier", "ece", "expected_cost",
    "delta_f1_vs_reference", "delta_cost_vs_reference",
)
DECISION_COLUMNS = (
    "dataset", "window_id", "scenario", "drift_feature_share",
    "delta_f1_vs_reference", "delta_cost_vs_reference",
    "policy_action", "trigger_reason",
)
RETRAIN_COLUMNS = (
    "dataset", "scenario", "phase", "accuracy", "f1", "roc_auc",
    "pr_auc", "brier", "ece", "expected_cost",
)
CALIBRATION_COLUMNS = (
    "dataset", "model", "variant", "split",
    "brier", "log_loss", "roc_auc", "pr_auc", "ece",
)
GRID_COLUMNS = (
    "dataset", "model", "variant", "threshold", "precision", "recall",
    "f1", "fp_rate", "fn_rate", "expected_cost",
)
POLICY_REPORT_COLUMNS = (
    "dataset", "model", "variant", "policy_name", "threshold", "accuracy",
    "f1", "roc_auc", "pr_auc", "expected_cost", "cost_per_100",
)
SEGMENT_POLICY_COLUMNS = (
    "dataset", "segment_feature", "segment", "n",
    "fp_rate", "fn_rate", "expected_cost_per_100",
)
FEATURE_SET_DECISION_COLUMNS = (
    "dataset", "model", "selected_feature_set", "train_f1", "validation_f1",
    "f1_gap", "abs_f1_gap", "tie_break_reason",
)

# Parameter grids (fixed values). A depth of None means no limit.
VALIDATION_CURVES = {
    "LogisticRegression": ("C", (0.01, 0.1, 1.0, 10.0, 100.0)),
    "RandomForest": ("max_depth", (2, 4, 6, 8, None)),
}
TUNING_GRIDS = {
    "LogisticRegression": {
        "C": (0.01, 0.1, 1.0, 10.0),
        "class_weight": (None, "balanced"),
    },
    "RandomForest": {
        "max_depth": (4, 8, None),
        "min_samples_leaf": (1, 5, 10),
        "class_weight": (None, "balanced"),
    },
}
MODEL_PRIORITY = {"LogisticRegression": 0, "RandomForest": 1}
PRIORITY_OTHERS = 99

SWEEP_THRESHOLDS = tuple(round(0.05 * k, 2) for k in range(1, 20))
COARSE_THRESHOLDS = tuple(round(0.1 * k, 1) for k in range(1, 10))
