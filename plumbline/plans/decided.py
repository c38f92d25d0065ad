"""Decision tables: calibration choice, thresholds, feature sets, tuning tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.functions import tidy
from plumbline.operators import calibration as K
from plumbline.operators import expectations as Q
from plumbline.operators import metrics as M
from plumbline.operators import models as H
from plumbline.operators import policy as P
from plumbline.operators import retrain as R
from plumbline.operators import selection as G
from plumbline.plans.catalogue import query
from plumbline.plans.measured import CALIBRATION, record_sql, sweep_sql, tidy_sql
from plumbline.plans.views import SCORED, num, rnd, scored

VARIANTS = {"v0": "uncalibrated", "v1": "calibrated_sigmoid", "v2": "calibrated_isotonic"}
SETS = {"v0": "full", "v1": "shortlist", "v2": "robust_D"}


def renamed(column: str, table) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {cases} END"


def rename(table):
    value = F.lit(None).cast("string")
    for old, new in table.items():
        value = F.when(F.col("variant") == old, F.lit(new)).otherwise(value)
    return value


AUDIT = f"""{record_sql('dataset, variant', 'dataset, variant')},
cal AS (SELECT dataset, {renamed('variant', VARIANTS)} AS variant, {', '.join(CALIBRATION)} FROM record),
best AS (SELECT * FROM cal WHERE variant <> 'uncalibrated'
  QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY brier, log_loss, ece, variant) = 1)"""


def audit(t):
    rows = scored(t).withColumns({"variant": rename(VARIANTS), "model": F.lit("fixed"), "split": F.lit("validation")})
    return rows, K.calibration_audit(rows)


@query("p01_best_variant", f"WITH {AUDIT} SELECT dataset, variant, {tidy_sql(CALIBRATION)} FROM best")
def _(t):
    best = K.best_calibrated_variant(audit(t)[1])
    return best.select("dataset", "variant", *[tidy(F.col(c)).alias(c) for c in CALIBRATION])


SIDES = ("uncalibrated_brier", "best_brier", "uncalibrated_ece", "best_ece")


@query(
    "p02_calibration_comparison",
    f"""WITH {AUDIT} SELECT b.dataset, b.variant AS calibrated_best_source, {rnd('u.brier')} AS uncalibrated_brier, {rnd('b.brier')} AS best_brier,
    {rnd('u.ece')} AS uncalibrated_ece, {rnd('b.ece')} AS best_ece FROM best b JOIN cal u ON u.dataset = b.dataset AND u.variant = 'uncalibrated'""",
)
def _(t):
    table = K.calibration_comparison(audit(t)[1])
    return table.select("dataset", "calibrated_best_source", *[tidy(F.col(c)).alias(c) for c in SIDES])


def chosen_sql(min_recall: float) -> str:
    return f"""{sweep_sql(C.SWEEP_THRESHOLDS, 'dataset, variant')}, chosen AS (
  SELECT *, CASE WHEN recall >= {num(min_recall)} THEN 'min_cost_recall_ge_{min_recall:.2f}' ELSE '{P.UNGUARDED}' END AS policy_name,
    recall >= {num(min_recall)} AS guardrail_passed FROM grid
  QUALIFY row_number() OVER (PARTITION BY dataset, variant ORDER BY CAST(recall >= {num(min_recall)} AS INT) DESC, expected_cost, f1 DESC, threshold) = 1)"""


def chosen(t, min_recall):
    grid = M.sweep_thresholds(scored(t), ["dataset", "variant"])
    return P.choose_threshold(grid, ["dataset", "variant"], min_recall)


SHOWN = ("recall", "f1", "expected_cost")


def guardrail_query(name: str, min_recall: float):
    @query(
        name,
        f"WITH {chosen_sql(min_recall)} SELECT dataset, variant, threshold, policy_name, guardrail_passed, {tidy_sql(SHOWN)} FROM chosen",
    )
    def _(t):
        table = chosen(t, min_recall)
        return table.select(
            "dataset", "variant", "threshold", "policy_name", "guardrail_passed", *[tidy(F.col(c)).alias(c) for c in SHOWN]
        )


guardrail_query("p03_threshold_guardrail", 0.60)
guardrail_query("p03_threshold_fallback", 0.999)


@query(
    "p04_final_policy",
    f"""WITH {chosen_sql(0.6)} SELECT dataset, variant, threshold, policy_name, {tidy_sql(SHOWN)} FROM chosen
    QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY expected_cost, f1 DESC, variant) = 1""",
)
def _(t):
    table = P.final_policy(chosen(t, 0.6))
    return table.select("dataset", "variant", "threshold", "policy_name", *[tidy(F.col(c)).alias(c) for c in SHOWN])


@query(
    "g12_referential_check",
    f"""WITH {chosen_sql(0.6)} SELECT dataset, variant, threshold FROM (SELECT dataset, variant,
      CASE WHEN variant = 'v1' THEN threshold + {num(0.001)} ELSE threshold END AS threshold FROM chosen) c
    WHERE NOT EXISTS (SELECT 1 FROM grid g WHERE g.dataset = c.dataset AND g.variant = c.variant AND round(g.threshold, 6) = round(c.threshold, 6))""",
)
def _(t):
    grid = M.sweep_thresholds(scored(t), ["dataset", "variant"])
    policies = P.choose_threshold(grid, ["dataset", "variant"], 0.6).select("dataset", "variant", "threshold")
    moved = F.when(F.col("variant") == "v1", F.col("threshold") + 0.001).otherwise(F.col("threshold"))
    return Q.orphans(policies.withColumn("threshold", moved), grid, ["dataset", "variant"], rounded="threshold").select(
        "dataset", "variant", "threshold"
    )


# --- generalisation and feature-set choice -------------------------------------------

KEYS = "dataset, model, variant, split"
GENERAL = f"""{record_sql(KEYS, KEYS)},
wide AS (SELECT dataset, model, {renamed('variant', SETS)} AS feature_set,
  {', '.join(f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in ('train', 'validation') for m in ('accuracy', 'f1', 'roc_auc'))}
  FROM record GROUP BY ALL),
summary AS (SELECT *, train_f1 - validation_f1 AS f1_gap, abs(train_f1 - validation_f1) AS abs_f1_gap,
  train_roc_auc - validation_roc_auc AS roc_auc_gap FROM wide)"""
GAPS = ("train_f1", "validation_f1", "f1_gap", "abs_f1_gap", "train_roc_auc", "validation_roc_auc", "roc_auc_gap")


def split_scores(t):
    """Fixed scores as three feature sets of two models on two splits."""
    return scored(t).withColumn("feature_set", rename(SETS)).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def summary(t):
    per_split = M.decision_metrics(split_scores(t), ["dataset", "feature_set", "model", "split"])
    return P.generalization_summary(per_split)


@query("i19_generalization_audit", f"WITH {GENERAL} SELECT dataset, model, feature_set, {tidy_sql(GAPS)} FROM summary")
def _(t):
    return summary(t).select("dataset", "model", "feature_set", *[tidy(F.col(c)).alias(c) for c in GAPS])


CLOSE = f"<= {num(1e-8)} + {num(1e-5)} * abs"
STAGES = f"""{GENERAL},
z1 AS (SELECT *, abs(validation_f1 - max(validation_f1) OVER g) {CLOSE}(max(validation_f1) OVER g) AS s1 FROM summary WINDOW g AS (PARTITION BY dataset, model)),
z2 AS (SELECT *, min(CASE WHEN s1 THEN abs_f1_gap END) OVER (PARTITION BY dataset, model) AS best_gap FROM z1),
z3 AS (SELECT *, s1 AND abs(abs_f1_gap - best_gap) {CLOSE}(best_gap) AS s2, CAST(feature_set = 'full' AS INT) AS fl FROM z2),
z4 AS (SELECT *, s2 AND fl = min(CASE WHEN s2 THEN fl END) OVER (PARTITION BY dataset, model) AS s3 FROM z3),
z5 AS (SELECT *, sum(CAST(s1 AS INT)) OVER g AS n1, sum(CAST(s2 AS INT)) OVER g AS n2, sum(CAST(s3 AS INT)) OVER g AS n3 FROM z4 WINDOW g AS (PARTITION BY dataset, model)),
picked AS (SELECT *, CASE WHEN n1 = 1 THEN 'best validation_f1' WHEN n2 = 1 THEN 'tie on validation_f1 -> min abs_f1_gap'
  WHEN n3 = 1 THEN 'tie on f1 and gap -> prefer non-full' ELSE 'tie on all -> lexicographic' END AS tie_break_reason
  FROM z5 WHERE s3 QUALIFY row_number() OVER (PARTITION BY dataset, model ORDER BY feature_set) = 1)"""
DECIDED = ("train_f1", "validation_f1", "f1_gap", "abs_f1_gap")


@query("p05_feature_set_winner", f"WITH {STAGES} SELECT dataset, model, feature_set AS selected_feature_set, {tidy_sql(DECIDED)} FROM picked")
def _(t):
    table = P.feature_set_decisions(summary(t))
    return table.select("dataset", "model", "selected_feature_set", *[tidy(F.col(c)).alias(c) for c in DECIDED])


@query("p06_tie_break_reason", f"WITH {STAGES} SELECT dataset, model, tie_break_reason FROM picked")
def _(t):
    return P.feature_set_decisions(summary(t)).select("dataset", "model", "tie_break_reason")


@query(
    "p07_decisions_table",
    f"WITH {STAGES} SELECT dataset, model, feature_set AS selected_feature_set, {tidy_sql(DECIDED)}, tie_break_reason FROM picked",
)
def _(t):
    table = P.feature_set_decisions(summary(t))
    return table.select(*[tidy(F.col(c)).alias(c) if c in DECIDED else F.col(c) for c in C.FEATURE_SET_DECISION_COLUMNS])


@query("g17_one_decision", f"WITH {STAGES} SELECT dataset, model, feature_set AS selected_feature_set FROM picked WHERE dataset = 'F' AND model = 'm1'")
def _(t):
    row = G.decision_of(P.feature_set_decisions(summary(t)), "F", "m1")
    return row.select("dataset", "model", "selected_feature_set")


# --- tables around model fits, with the fixed score in place of a model ----------------


@query(
    "h04_balanced_weights",
    f"""WITH {SCORED} SELECT y, CAST(count(*) AS BIGINT) AS n, {rnd('(SELECT count(*) FROM scored) / (2 * CAST(count(*) AS DOUBLE))')} AS weight FROM scored GROUP BY y""",
)
def _(t):
    rows = scored(t).select("y")
    weighted = rows.withColumn("weight", H.balanced_weight(H.class_counts(rows)))
    return weighted.groupBy("y").agg(F.count(F.lit(1)).alias("n"), tidy(F.max("weight")).alias("weight"))


SPLIT = ("accuracy", "f1", "roc_auc")


@query(
    "h07_split_metrics",
    f"WITH {record_sql('dataset, split', 'dataset, split')} SELECT dataset, split, {tidy_sql(SPLIT)} FROM record",
)
def _(t):
    table = M.decision_metrics(split_scores(t), ["dataset", "split"])
    return table.select("dataset", "split", *[tidy(F.col(c)).alias(c) for c in SPLIT])


@query(
    "h08_comparison_long",
    f"""WITH {record_sql('dataset, model, variant', 'dataset, model, variant')},
    w AS (SELECT dataset, {renamed('variant', SETS)} AS feature_set, model, accuracy, f1, roc_auc FROM record)
    SELECT dataset, feature_set, model, metric, {rnd('value')} AS value FROM w UNPIVOT (value FOR metric IN (accuracy, f1, roc_auc))""",
)
def _(t):
    keys = ["dataset", "feature_set", "model"]
    table = M.to_long(M.decision_metrics(split_scores(t), keys), keys, SPLIT)
    return table.withColumn("value", tidy(F.col("value")))


FOLDS = f"{record_sql('dataset, variant, fold', 'dataset, variant, fold')}"


@query("i18_fold_metrics", f"WITH {FOLDS} SELECT dataset, variant, fold, {tidy_sql(SPLIT)} FROM record")
def _(t):
    table = H.cv_stability(split_scores(t), ["dataset", "variant"])
    return table.select("dataset", "variant", "fold", *[tidy(F.col(c)).alias(c) for c in SPLIT])


CV = ", ".join(
    f"{rnd(f'avg({m})')} AS mean_cv_{m}, {rnd(f'stddev_pop({m})')} AS std_cv_{m}" for m in SPLIT
)


@query(
    "h09_grid_table",
    f"""WITH {FOLDS}, s AS (SELECT dataset, variant, '{{"C":"' || right(variant, 1) || '","class_weight":"balanced"}}' AS params_json, avg(f1) AS raw_f1, {CV}
      FROM record GROUP BY dataset, variant)
    SELECT dataset, params_json, {', '.join(f'mean_cv_{m}, std_cv_{m}' for m in SPLIT)}, CAST(row_number() OVER (PARTITION BY dataset ORDER BY raw_f1 DESC, variant) AS INT) AS rank
    FROM s QUALIFY rank <= 2""",
)
def _(t):
    from plumbline.functions import sorted_json

    weak = F.create_map(F.lit("class_weight"), F.lit("balanced"), F.lit("C"), F.right("variant", F.lit(1)))
    rows = split_scores(t).withColumns(
        {
            "param_id": F.right("variant", F.lit(1)).cast("int"),
            "params_json": sorted_json(weak),
            "model": F.lit("LogisticRegression"),
            "feature_set": F.lit("full"),
        }
    )
    keys = ["dataset", "feature_set", "model", "param_id", "params_json"]
    top = H.top_grid_rows(H.cv_summary(H.cv_stability(rows, keys), keys), 2)
    numbers = [f"{s}_cv_{m}" for m in SPLIT for s in ("mean", "std")]
    return top.select("dataset", "params_json", "rank", *[tidy(F.col(c)).alias(c) for c in numbers])


TWO_SIDES = "SELECT * REPLACE (CASE variant WHEN 'v0' THEN 'v0' ELSE 'v1' END AS variant) FROM"
COMPARED = f"""{record_sql('dataset, model, variant', 'dataset, model, variant').replace('scored AS (', f'scored AS ({TWO_SIDES} (', 1).replace('FROM lineitem)', 'FROM lineitem))', 1)},
compared AS (SELECT dataset, CASE model WHEN 'm0' THEN 'LogisticRegression' ELSE 'RandomForest' END AS model, 'full' AS feature_set,
  CASE variant WHEN 'v0' THEN 'baseline_default' ELSE 'tuned_best' END AS variant, accuracy, f1, roc_auc FROM record)"""


def compared(t):
    rows = split_scores(t).withColumns(
        {
            "variant": F.when(F.col("variant") == "v0", F.lit("baseline_default")).otherwise(F.lit("tuned_best")),
            "model": F.when(F.col("model") == "m0", F.lit("LogisticRegression")).otherwise(F.lit("RandomForest")),
            "feature_set": F.lit("full"),
        }
    )
    return M.decision_metrics(rows, ["dataset", "model", "feature_set", "variant"])


@query("h10_baseline_vs_tuned", f"WITH {COMPARED} SELECT dataset, model, feature_set, variant, {tidy_sql(SPLIT)} FROM compared")
def _(t):
    return compared(t).select("dataset", "model", "feature_set", "variant", *[tidy(F.col(c)).alias(c) for c in SPLIT])


@query(
    "h11_validation_winner",
    f"""WITH {COMPARED} SELECT dataset, model, variant, {tidy_sql(SPLIT)} FROM compared QUALIFY row_number() OVER (PARTITION BY dataset
      ORDER BY f1 DESC, roc_auc DESC, CASE model WHEN 'LogisticRegression' THEN 0 ELSE 1 END, model, variant) = 1""",
)
def _(t):
    return P.validation_winner(compared(t)).select("dataset", "model", "variant", *[tidy(F.col(c)).alias(c) for c in SPLIT])


@query(
    "h13_reference_metrics",
    f"""WITH {record_sql('dataset, variant', 'dataset, variant')} SELECT dataset, variant AS model_variant,
    {tidy_sql(R.METRICS)} FROM record""",
)
def _(t):
    table = R.reference_metrics(scored(t).withColumn("model_variant", F.col("variant")))
    return table.select("dataset", "model_variant", *[tidy(F.col(c)).alias(c) for c in R.METRICS])


@query(
    "h06_margin_score",
    f"""SELECT l_orderkey, l_linenumber, {rnd(f'1 / (1 + exp(-least(greatest(l_quantity - {num(25.0)}, -40), 40)))', 9)} AS score,
    'decision_function_sigmoid' AS score_source FROM lineitem""",
)
def _(t):
    from pyspark.ml.functions import array_to_vector

    margin = F.col("l_quantity") - 25.0
    raw = t("lineitem").withColumn("rawPrediction", array_to_vector(F.array(-margin, margin)))
    return H.with_score(raw).select("l_orderkey", "l_linenumber", tidy(F.col("score"), 9).alias("score"), "score_source")


@query(
    "k15_retrain_gain",
    f"""WITH {record_sql('dataset, window_id, variant', 'dataset, window_id, variant').replace('scored AS (', f'scored AS ({TWO_SIDES} (', 1).replace('FROM lineitem)', 'FROM lineitem))', 1)}
    SELECT a.dataset, 'y' || CAST(a.window_id AS VARCHAR) AS scenario, {rnd('b.f1 - a.f1')} AS f1_gain, {rnd('a.expected_cost - b.expected_cost')} AS cost_saving
    FROM record a JOIN record b ON a.dataset = b.dataset AND a.window_id = b.window_id AND a.variant = 'v0' AND b.variant = 'v1'""",
)
def _(t):
    rows = scored(t).withColumns(
        {
            "scenario": F.concat(F.lit("y"), F.col("window_id").cast("string")),
            "phase": F.when(F.col("variant") == "v0", F.lit("before_retrain")).otherwise(F.lit("after_retrain")),
        }
    )
    gain = R.retrain_gain(M.metric_record(rows, ["dataset", "scenario", "phase"]))
    return gain.select("dataset", "scenario", *[tidy(F.col(c)).alias(c) for c in ("f1_gain", "cost_saving")])
