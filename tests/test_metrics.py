"""Hand-made cases with exact answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import calibration as K
from plumbline.operators import metrics as M
from plumbline.operators import policy as P
from plumbline.operators import retrain as R
from plumbline.operators import segments as S


def scored(spark, y, p):
    rows = [(i, "d", int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "row_id int, k string, y int, score double")


def test_expected_cost_total_and_mean(spark):
    y, d = [1, 1, 0, 0, 1, 0], [1, 0, 1, 0, 0, 0]
    df = spark.createDataFrame(list(zip(y, d)), "y int, predicted int")
    assert M.expected_cost(df, [], 2.0, 5.0, normalize=False).first()[0] == 12.0
    assert M.expected_cost(df, [], 2.0, 5.0).first()[0] == 2.0


def test_sweep_matches_direct_counts(spark):
    y, p = [0, 0, 1, 1, 1, 0, 1, 0], [0.1, 0.2, 0.8, 0.9, 0.65, 0.4, 0.55, 0.3]
    rows = M.sweep_thresholds(scored(spark, y, p), ["k"], [0.3, 0.5, 0.7]).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == [0.3, 0.5, 0.7]
    for r in rows:
        hit = np.array(p) >= r["threshold"]
        assert r["tp"] == int((hit & (np.array(y) == 1)).sum())
        assert r["fp"] == int((hit & (np.array(y) == 0)).sum())
        assert r["n"] == 8


GRID = "k string, threshold double, recall double, f1 double, expected_cost double"


def test_guardrail_keeps_recall(spark):
    grid = spark.createDataFrame(
        [("a", 0.3, 0.90, 0.55, 0.45), ("a", 0.5, 0.65, 0.62, 0.40), ("a", 0.7, 0.40, 0.53, 0.35)], GRID
    )
    row = P.choose_threshold(grid, ["k"], 0.60).first()
    assert (row["threshold"], row["guardrail_passed"]) == (0.5, True)
    assert row["policy_name"] == "min_cost_recall_ge_0.60"


def test_guardrail_falls_back_to_cheapest(spark):
    grid = spark.createDataFrame([("a", 0.6, 0.50, 0.58, 0.35), ("a", 0.8, 0.30, 0.45, 0.33)], GRID)
    row = P.choose_threshold(grid, ["k"], 0.90).first()
    assert (row["threshold"], row["guardrail_passed"]) == (0.8, False)
    assert row["policy_name"] == "min_cost_without_recall_guardrail"


def test_published_threshold_choice(spark):
    """Cost is fp_rate + 5 fn_rate; the cheaper of two candidates wins per dataset."""
    policies = spark.createDataFrame(
        [("x", "u", 0.3, 0.577, 0.59), ("x", "c", 0.2, 0.577, 0.60), ("z", "u", 0.2, 0.70, 0.4), ("z", "c", 0.1, 0.68, 0.3)],
        "dataset string, variant string, threshold double, expected_cost double, f1 double",
    )
    rows = {r["dataset"]: r["variant"] for r in P.final_policy(policies).collect()}
    assert rows == {"x": "c", "z": "c"}


def test_ece_bounds_and_zero_score(spark):
    y = [0, 1, 0, 1, 1, 0, 1, 0, 1, 0]
    p = [0.1, 0.8, 0.3, 0.7, 0.9, 0.2, 0.65, 0.4, 0.55, 0.15]
    assert 0.0 <= M.calibration_error(scored(spark, y, p), ["k"], 5).first()["ece"] <= 1.0
    # A score of exactly 0 is in no bin but stays in the total.
    half = scored(spark, [1, 1], [0.0, 0.5])
    assert M.calibration_error(half, ["k"], 10).first()["ece"] == pytest.approx(0.25)
    assert M.calibration_error(half, ["k"], 10, include_zero=True).first()["ece"] == pytest.approx(0.75)
    with pytest.raises(ValueError):
        M.calibration_error(half, ["k"], 1)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_ap(y, p):
    total = 0.0
    for t in np.unique(p):
        kept = p >= t
        total += (y[p == t] == 1).sum() * (y[kept] == 1).sum() / kept.sum()
    return total / (y == 1).sum()


@pytest.mark.parametrize("hot", [False, True])
def test_ranking_metrics_are_exact(spark, hot):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(800), 2)
    if hot:
        p[: len(p) // 2] = 0.37  # one score holds half of all rows
    y = (rng.random(800) < 0.3 + 0.4 * p).astype(int)
    row = M.metric_record(scored(spark, y, p), ["k"], buckets=16).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(brute_ap(y, p), abs=1e-12)
    assert row["brier"] == pytest.approx(np.mean((p - y) ** 2), abs=1e-12)
    safe = np.clip(p, 1e-6, 1 - 1e-6)
    assert row["log_loss"] == pytest.approx(-np.mean(y * np.log(safe) + (1 - y) * np.log(1 - safe)), abs=1e-12)
    assert row["accuracy"] == pytest.approx(np.mean((p >= 0.5) == (y == 1)))
    assert row["ece"] == pytest.approx(M.calibration_error(scored(spark, y, p), ["k"]).first()["ece"], abs=1e-12)


def test_one_class_has_no_ranking(spark):
    row = M.ranking_metrics(scored(spark, [1, 1], [0.2, 0.4]), ["k"]).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None


def test_best_variant_has_lowest_brier(spark):
    audit = spark.createDataFrame(
        [
            ("m", "rf", "uncalibrated", "validation", 0.100, 0.5, 0.7, 0.5, 0.01),
            ("m", "rf", "calibrated_sigmoid", "validation", 0.190, 0.58, 0.70, 0.52, 0.05),
            ("m", "rf", "calibrated_isotonic", "validation", 0.170, 0.60, 0.69, 0.51, 0.04),
        ],
        "dataset string, model string, variant string, split string, brier double, log_loss double, roc_auc double, pr_auc double, ece double",
    )
    assert K.best_calibrated_variant(audit).first()["variant"] == "calibrated_isotonic"
    row = K.calibration_comparison(audit).first()
    assert (row["uncalibrated_brier"], row["best_brier"]) == (0.100, 0.170)


def test_retrain_rule(spark):
    """Published windows: (share, change of F1, change of cost) -> action and reasons."""
    cases = [
        (0.10, -0.01, 0.02, "observe", "no_trigger"),
        (0.34, -0.02, 0.03, "retrain", "drift_share"),
        (0.30, -0.05, 0.15, "retrain", "drift_share;f1_drop;cost_increase"),
        (0.29, -0.049, 0.149, "observe", "no_trigger"),
        (0.07, 0.10, 0.40, "retrain", "cost_increase"),
    ]
    df = spark.createDataFrame(
        cases,
        "drift_feature_share double, delta_f1_vs_reference double, delta_cost_vs_reference double, action string, reason string",
    )
    for r in R.with_action(df).collect():
        assert (r["policy_action"], r["trigger_reason"]) == (r["action"], r["reason"])


def test_decisions_need_their_columns(spark):
    with pytest.raises(ValueError):
        R.retraining_decisions(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "a int"))


SUMMARY = "dataset string, model string, feature_set string, train_f1 double, validation_f1 double, f1_gap double, abs_f1_gap double"


@pytest.mark.parametrize(
    "rows, winner, reason",
    [
        ([("full", 0.9, 0.8), ("shortlist", 0.9, 0.7)], "full", "best validation_f1"),
        ([("full", 0.9, 0.8), ("shortlist", 0.85, 0.8)], "shortlist", "tie on validation_f1 -> min abs_f1_gap"),
        ([("full", 0.9, 0.8), ("shortlist", 0.9, 0.8)], "shortlist", "tie on f1 and gap -> prefer non-full"),
        ([("robust_D", 0.9, 0.8), ("shortlist", 0.9, 0.8), ("full", 0.9, 0.8)], "robust_D", "tie on all -> lexicographic"),
    ],
)
def test_feature_set_choice(spark, rows, winner, reason):
    table = spark.createDataFrame([("d", "m", s, a, b, a - b, abs(a - b)) for s, a, b in rows], SUMMARY)
    row = P.feature_set_decisions(table).first()
    assert (row["selected_feature_set"], row["tie_break_reason"]) == (winner, reason)


def test_segments_keep_nulls_and_fold_few_values(spark):
    rows = [(i, 1, 0 if i % 2 else 1, float(i % 2) if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, y int, predicted int, v double")
    table = {r["segment"]: r["n"] for r in S.segment_errors(df, "v").collect()}
    assert table["missing"] == 8 and sum(table.values()) == 40
    same = df.withColumn("v", F.lit(3.0))
    assert [r["segment"] for r in S.segment_errors(same, "v").collect()] == ["all"]
