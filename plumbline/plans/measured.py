"""Metric queries (grouped aggregations over scored rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.functions import at_least, equal_edges, tidy
from plumbline.operators import metrics as M
from plumbline.operators import segments as S
from plumbline.plans.catalogue import query
from plumbline.plans.views import SCORED, div, num, right_closed, rnd, scored

DECIDED = f"""{SCORED}, decided AS (
  SELECT *, CAST(score >= {num(0.5)} AS INT) AS predicted FROM scored)"""
COUNTS = """CAST(count(*) FILTER (WHERE y = 1 AND predicted = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE y = 0 AND predicted = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE y = 1 AND predicted = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE y = 0 AND predicted = 0) AS BIGINT) AS tn,
  CAST(count(*) AS BIGINT) AS n"""
RATES = {
    "accuracy": div("tp + tn", "n"),
    "precision": div("tp", "tp + fp"),
    "recall": div("tp", "tp + fn"),
    "f1": div("2 * tp", "2 * tp + fp + fn"),
    "fp_rate": div("fp", "n"),
    "fn_rate": div("fn", "n"),
    "error_rate": div("fp + fn", "n"),
    "expected_cost": div("fp + 5 * fn", "n"),
    "cost_per_100": div("100 * (fp + 5 * fn)", "n"),
}


def rate(*names: str) -> str:
    return ", ".join(f"{rnd(RATES[n])} AS {n}" for n in names)


def ranks(keys: str) -> str:
    """ROC-AUC and average precision from per-score counts, one ordered window."""
    return f"""per_score AS (
  SELECT {keys}, score, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg
  FROM scored GROUP BY {keys}, score),
running AS (
  SELECT *, sum(neg) OVER (PARTITION BY {keys} ORDER BY score) - neg AS below,
         sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC) AS tp,
         sum(pos + neg) OVER (PARTITION BY {keys} ORDER BY score DESC) AS kept,
         sum(pos) OVER (PARTITION BY {keys}) AS all_pos, sum(neg) OVER (PARTITION BY {keys}) AS all_neg
  FROM per_score),
ordered AS (
  SELECT {keys}, sum(pos * (below + neg / 2)) / (max(all_pos) * max(all_neg)) AS roc_auc,
         sum(pos * tp / kept) / max(all_pos) AS pr_auc
  FROM running GROUP BY {keys})"""


EDGES = equal_edges(10)
BINNED = f"""binned AS (
  SELECT *, {right_closed('score', EDGES)} AS bin FROM scored)"""


def reliability(keys: str) -> str:
    return f"""{BINNED}, reliability AS (
  SELECT {keys}, bin, CAST(count(*) AS BIGINT) AS n, avg(score) AS prob_mean, avg(CAST(y AS DOUBLE)) AS target_rate
  FROM binned WHERE bin >= 1 GROUP BY {keys}, bin),
totals AS (SELECT {keys}, count(*) AS total FROM scored GROUP BY {keys}),
ece AS (
  SELECT {keys}, sum(n * abs(prob_mean - target_rate)) / max(total) AS ece
  FROM reliability JOIN totals USING ({keys}) GROUP BY {keys})"""


def loss(eps: float = 1e-6) -> str:
    safe = f"least(greatest(score, {num(eps)}), {num(1.0 - eps)})"
    return f"-avg(y * ln({safe}) + (1 - y) * ln(1 - {safe}))"


PROBABILITY = f"avg((score - y) * (score - y)) AS brier, {loss()} AS log_loss"
KEYS = ["dataset", "variant"]
K = "dataset, variant"


@query("i01_confusion_counts", f"WITH {DECIDED} SELECT {K}, {COUNTS} FROM decided GROUP BY {K}")
def _(t):
    rows = scored(t).withColumn("predicted", at_least(F.col("score"), 0.5))
    return M.confusion_counts(rows, KEYS)


@query(
    "i02_classification_metrics",
    f"""WITH {DECIDED}, c AS (SELECT {K}, {COUNTS} FROM decided GROUP BY {K})
    SELECT {K}, {rate('accuracy', 'precision', 'recall', 'f1')} FROM c""",
)
def _(t):
    table = M.threshold_metrics(scored(t), KEYS, 0.5)
    return table.select(*KEYS, *[tidy(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("i03_roc_auc", f"WITH {SCORED}, {ranks(K)} SELECT {K}, {rnd('roc_auc')} AS roc_auc FROM ordered")
def _(t):
    return M.ranking_metrics(scored(t), KEYS).select(*KEYS, tidy(F.col("roc_auc")).alias("roc_auc"))


@query("i04_pr_auc", f"WITH {SCORED}, {ranks(K)} SELECT {K}, {rnd('pr_auc')} AS pr_auc FROM ordered")
def _(t):
    return M.ranking_metrics(scored(t), KEYS).select(*KEYS, tidy(F.col("pr_auc")).alias("pr_auc"))


@query("i05_brier", f"WITH {SCORED} SELECT {K}, {rnd('avg((score - y) * (score - y))')} AS brier FROM scored GROUP BY {K}")
def _(t):
    return M.probability_metrics(scored(t), KEYS).select(*KEYS, tidy(F.col("brier")).alias("brier"))


@query("i06_log_loss", f"WITH {SCORED} SELECT {K}, {rnd(loss())} AS log_loss FROM scored GROUP BY {K}")
def _(t):
    return M.probability_metrics(scored(t), KEYS).select(*KEYS, tidy(F.col("log_loss")).alias("log_loss"))


@query("i07_ece", f"WITH {SCORED}, {reliability('variant')} SELECT variant, {rnd('ece')} AS ece FROM ece")
def _(t):
    return M.calibration_error(scored(t), ["variant"]).select("variant", tidy(F.col("ece")).alias("ece"))


@query(
    "i07_ece_with_zero",
    f"""WITH {SCORED}, b AS (SELECT *, greatest({right_closed('score', equal_edges(5))}, 1) AS bin FROM scored),
    g AS (SELECT variant, bin, count(*) AS n, abs(avg(score) - avg(y)) AS gap FROM b GROUP BY variant, bin)
    SELECT variant, {rnd('sum(n * gap) / sum(n)')} AS ece FROM g GROUP BY variant""",
)
def _(t):
    return M.calibration_error(scored(t), ["variant"], n_bins=5, include_zero=True).select(
        "variant", tidy(F.col("ece")).alias("ece")
    )


@query(
    "i08_reliability_table",
    f"""WITH {SCORED}, {reliability(K)} SELECT {K}, bin, n, {rnd('prob_mean')} AS prob_mean,
    {rnd('target_rate')} AS target_rate, {rnd('abs(prob_mean - target_rate)')} AS abs_gap FROM reliability""",
)
def _(t):
    table = M.reliability_table(scored(t), KEYS)
    return table.select(*KEYS, "bin", "n", *[tidy(F.col(c)).alias(c) for c in ("prob_mean", "target_rate", "abs_gap")])


@query(
    "i09_calibration_gap",
    f"""WITH {SCORED}, {reliability(K)} SELECT {K}, {rnd('avg(abs(prob_mean - target_rate))')} AS mean_abs_gap
    FROM reliability GROUP BY {K}""",
)
def _(t):
    table = M.calibration_gap(M.reliability_table(scored(t), KEYS), KEYS)
    return table.select(*KEYS, tidy(F.col("mean_abs_gap")).alias("mean_abs_gap"))


@query(
    "i10_expected_cost",
    f"""WITH {DECIDED}, c AS (SELECT {K}, {COUNTS} FROM decided GROUP BY {K})
    SELECT {K}, {rnd(div('2 * fp + 5 * fn', 'n'))} AS expected_cost, CAST(2 * fp + 5 * fn AS DOUBLE) AS total_cost FROM c""",
)
def _(t):
    rows = scored(t).withColumn("predicted", at_least(F.col("score"), 0.5))
    mean = M.confusion_counts(rows, KEYS).withColumns(M.from_confusion(fp_cost=2.0, fn_cost=5.0))
    return mean.select(*KEYS, tidy(F.col("expected_cost")).alias("expected_cost"), "total_cost")


@query(
    "i11_cost_per_100",
    f"WITH {DECIDED}, c AS (SELECT {K}, {COUNTS} FROM decided GROUP BY {K}) SELECT {K}, {rate('cost_per_100')} FROM c",
)
def _(t):
    return M.threshold_metrics(scored(t), KEYS, 0.5).select(*KEYS, tidy(F.col("cost_per_100")).alias("cost_per_100"))


RECORD = ("accuracy", "f1", "roc_auc", "pr_auc", "brier", "ece", "expected_cost")


def record_sql(keys: str, using: str) -> str:
    """CTE `record`: every metric per key at threshold 0.5."""
    return f"""{DECIDED}, {ranks(keys)}, {reliability(keys)},
c AS (SELECT {keys}, {COUNTS} FROM decided GROUP BY {keys}),
p AS (SELECT {keys}, {PROBABILITY} FROM scored GROUP BY {keys}),
record AS (SELECT {keys}, tp, fp, fn, tn, n, {RATES['accuracy']} AS accuracy, {RATES['f1']} AS f1, roc_auc, pr_auc,
  brier, log_loss, ece, {RATES['expected_cost']} AS expected_cost, {RATES['cost_per_100']} AS cost_per_100
  FROM c JOIN p USING ({using}) JOIN ordered USING ({using}) JOIN ece USING ({using}))"""


def tidy_sql(columns) -> str:
    return ", ".join(f"{rnd(c)} AS {c}" for c in columns)


@query("i12_metric_record", f"WITH {record_sql(K, K)} SELECT {K}, {tidy_sql(RECORD)} FROM record")
def _(t):
    return M.metric_record(scored(t), KEYS).select(*KEYS, *[tidy(F.col(c)).alias(c) for c in RECORD])


CALIBRATION = ("brier", "log_loss", "roc_auc", "pr_auc", "ece")


@query(
    "i13_calibration_record",
    f"""WITH {record_sql(K, K)} SELECT dataset, 'fixed_score' AS model, variant, 'validation' AS split,
    {tidy_sql(CALIBRATION)} FROM record""",
)
def _(t):
    from plumbline.operators.calibration import calibration_audit

    rows = scored(t).withColumns({"model": F.lit("fixed_score"), "split": F.lit("validation")})
    audit = calibration_audit(rows)
    return audit.select(*C.CALIBRATION_COLUMNS[:4], *[tidy(F.col(c)).alias(c) for c in CALIBRATION])


@query(
    "i14_threshold_metrics",
    f"""WITH {SCORED}, decided AS (SELECT *, CAST(score >= {num(0.35)} AS INT) AS predicted FROM scored),
    c AS (SELECT variant, {COUNTS} FROM decided GROUP BY variant)
    SELECT variant, {num(0.35)} AS threshold, {rate('accuracy', 'precision', 'recall', 'f1')} FROM c""",
)
def _(t):
    table = M.threshold_metrics(scored(t), ["variant"], 0.35)
    return table.select(
        "variant",
        F.lit(0.35).alias("threshold"),
        *[tidy(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
    )


def sweep_sql(thresholds, keys: str) -> str:
    values = ", ".join(f"({num(x)})" for x in thresholds)
    return f"""{SCORED}, steps(threshold) AS (VALUES {values}),
decided AS (SELECT scored.*, threshold, CAST(score >= threshold AS INT) AS predicted FROM scored, steps),
counts AS (SELECT {keys}, threshold, {COUNTS} FROM decided GROUP BY {keys}, threshold),
grid AS (SELECT {keys}, threshold, {RATES['precision']} AS precision, {RATES['recall']} AS recall, {RATES['f1']} AS f1,
  {RATES['fp_rate']} AS fp_rate, {RATES['fn_rate']} AS fn_rate, {RATES['expected_cost']} AS expected_cost FROM counts)"""


GRID = ("precision", "recall", "f1", "fp_rate", "fn_rate", "expected_cost")


@query(
    "i15_threshold_sweep",
    f"WITH {sweep_sql(C.SWEEP_THRESHOLDS, K)} SELECT {K}, threshold, {tidy_sql(GRID)} FROM grid",
)
def _(t):
    return M.sweep_thresholds(scored(t), KEYS).select(*KEYS, "threshold", *[tidy(F.col(c)).alias(c) for c in GRID])


@query(
    "i15_coarse_sweep",
    f"WITH {sweep_sql(C.COARSE_THRESHOLDS, 'dataset')} SELECT dataset, threshold, {tidy_sql(GRID[:3])} FROM grid",
)
def _(t):
    grid = M.sweep_thresholds(scored(t), ["dataset"], C.COARSE_THRESHOLDS)
    return grid.select("dataset", "threshold", *[tidy(F.col(c)).alias(c) for c in GRID[:3]])


def segment_sql(value: str, bins: int = 4) -> str:
    """Quantile bins (lo, hi]; null is its own segment."""
    edges = ", ".join(f"round(quantile_cont({value}, {num(k / bins)}), 9)" for k in range(bins + 1))
    return f"""{DECIDED}, cuts AS (SELECT list_sort(list_distinct([{edges}])) AS e FROM scored),
placed AS (SELECT decided.*, CASE WHEN {value} IS NULL THEN NULL ELSE least(greatest((
    SELECT count(*) FROM (SELECT unnest(e) AS edge) WHERE edge < {value}), 1), len(e) - 1) END AS bin, e
  FROM decided, cuts),
segmented AS (SELECT y, predicted, e[bin] AS segment_lo, e[bin + 1] AS segment_hi,
  CASE WHEN bin IS NULL THEN 'missing' ELSE
    '(' || printf('%.3f', CASE WHEN bin = 1 THEN e[bin] - {num(0.001)} ELSE e[bin] END) || ', ' || printf('%.3f', e[bin + 1]) || ']'
  END AS segment FROM placed)"""


SEGMENT_RATES = f"""{rnd(RATES['error_rate'])} AS error_rate, {rnd(RATES['fp_rate'])} AS false_positive_rate,
{rnd(RATES['fn_rate'])} AS false_negative_rate"""


@query(
    "i16_segment_errors_numeric",
    f"""WITH {segment_sql('quantity')}, c AS (SELECT segment, segment_lo, segment_hi, {COUNTS} FROM segmented GROUP BY ALL)
    SELECT 'quantity' AS segment_feature, segment, segment_lo, segment_hi, n, {SEGMENT_RATES} FROM c""",
)
def _(t):
    rows = scored(t).withColumn("predicted", at_least(F.col("score"), 0.5))
    table = S.segment_errors(rows, "quantity")
    rates = ("error_rate", "false_positive_rate", "false_negative_rate")
    return table.select(
        "segment_feature", "segment", "segment_lo", "segment_hi", "n", *[tidy(F.col(c)).alias(c) for c in rates]
    )


@query(
    "i16_segment_errors_category",
    f"""WITH {DECIDED}, c AS (SELECT variant AS segment, {COUNTS} FROM decided GROUP BY variant)
    SELECT 'variant' AS segment_feature, segment, n, {SEGMENT_RATES} FROM c""",
)
def _(t):
    rows = scored(t).withColumn("predicted", at_least(F.col("score"), 0.5))
    rates = ("error_rate", "false_positive_rate", "false_negative_rate")
    return S.segment_errors(rows, "variant").select(
        "segment_feature", "segment", "n", *[tidy(F.col(c)).alias(c) for c in rates]
    )


@query(
    "i17_segment_policy_audit",
    f"""WITH {segment_sql('nullif(tax, 0)')}, c AS (SELECT segment, {COUNTS} FROM segmented GROUP BY segment)
    SELECT 'lines' AS dataset, 'tax' AS segment_feature, segment, n,
    {rnd(RATES['fp_rate'])} AS fp_rate, {rnd(RATES['fn_rate'])} AS fn_rate, {rnd(RATES['cost_per_100'])} AS expected_cost_per_100 FROM c""",
)
def _(t):
    rows = scored(t).withColumns(
        {"predicted": at_least(F.col("score"), 0.5), "tax": F.nullif(F.col("tax"), F.lit(0.0))}
    )
    table = S.segment_policy_audit(rows, "tax", "lines")
    rates = ("fp_rate", "fn_rate", "expected_cost_per_100")
    return table.select("dataset", "segment_feature", "segment", "n", *[tidy(F.col(c)).alias(c) for c in rates])


@query(
    "i20_fixed_policy_report",
    f"""WITH {record_sql('dataset', 'dataset')} SELECT dataset, 'fixed_half' AS policy_name, {num(0.5)} AS threshold,
    {tidy_sql(('accuracy', 'f1', 'roc_auc', 'pr_auc', 'expected_cost', 'cost_per_100'))} FROM record""",
)
def _(t):
    from plumbline.operators.policy import evaluate_policy

    report = evaluate_policy(scored(t), ["dataset"], 0.5)
    names = ("accuracy", "f1", "roc_auc", "pr_auc", "expected_cost", "cost_per_100")
    return report.select(
        "dataset", F.lit("fixed_half").alias("policy_name"), "threshold", *[tidy(F.col(c)).alias(c) for c in names]
    )
