"""Grouped quality, calibration and cost metrics of scored rows.

Input rows carry a 0/1 label, a score and any key columns. Metrics that depend on
the order of scores (ROC-AUC, average precision) start from per-score counts, so
equal scores collapse before the shuffle and ties get mid-ranks for free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import constants as C
from plumbline.functions import (
    at_least,
    bin_right_closed,
    clip,
    double,
    edges_below,
    equal_edges,
)
from plumbline.operators.ordered import BUCKET, range_cuts, running_totals, with_buckets


# --- counts of a 0/1 decision -------------------------------------------------


def confusion(y: Column, predicted: Column) -> dict[str, Column]:
    """Aggregates tp, fp, fn, tn, n."""
    return {
        "tp": F.count_if((y == 1) & (predicted == 1)),
        "fp": F.count_if((y == 0) & (predicted == 1)),
        "fn": F.count_if((y == 1) & (predicted == 0)),
        "tn": F.count_if((y == 0) & (predicted == 0)),
        "n": F.count(F.lit(1)),
    }


def from_confusion(fp_cost: float = C.FP_COST, fn_cost: float = C.FN_COST) -> dict[str, Column]:
    """Rates and costs as expressions over columns tp, fp, fn, tn, n; 0 for 0/0."""
    total = f"({double(fp_cost)} * fp + {double(fn_cost)} * fn)"

    def share(a: str, b: str) -> Column:
        return F.expr(f"coalesce(try_divide(double({a}), double({b})), 0D)")

    return {
        "accuracy": share("tp + tn", "n"),
        "precision": share("tp", "tp + fp"),
        "recall": share("tp", "tp + fn"),
        "f1": share("2 * tp", "2 * tp + fp + fn"),
        "fp_rate": share("fp", "n"),
        "fn_rate": share("fn", "n"),
        "error_rate": share("fp + fn", "n"),
        "total_cost": F.expr(total),
        "expected_cost": share(total, "n"),
        "cost_per_100": share(f"100D * {total}", "n"),
    }


def confusion_counts(
    df: DataFrame, keys: Sequence[str], y: str = "y", predicted: str = "predicted"
) -> DataFrame:
    aggregates = confusion(F.col(y), F.col(predicted))
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in aggregates.items()])


def threshold_metrics(
    df: DataFrame,
    keys: Sequence[str],
    threshold: float,
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
) -> DataFrame:
    """All decision metrics at one threshold."""
    decided = df.withColumn("predicted", at_least(F.col("score"), threshold))
    counts = confusion_counts(decided, keys)
    return counts.withColumns(from_confusion(fp_cost, fn_cost))


def expected_cost(
    df: DataFrame,
    keys: Sequence[str],
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
    normalize: bool = True,
    y: str = "y",
    predicted: str = "predicted",
) -> DataFrame:
    """Cost of errors per row, or in total."""
    value = from_confusion(fp_cost, fn_cost)["expected_cost" if normalize else "total_cost"]
    return confusion_counts(df, keys, y, predicted).select(*keys, value.alias("expected_cost"))


def sweep_thresholds(
    df: DataFrame,
    keys: Sequence[str],
    thresholds: Sequence[float] = C.SWEEP_THRESHOLDS,
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
) -> DataFrame:
    """Decision metrics for every threshold from one pass over the rows.

    Each row falls into one interval between thresholds; decisions at t are the
    sum of the intervals from t upwards. The cumulated table has
    (thresholds + 1) rows per key, so nothing is repeated per threshold.
    """
    steps = sorted(set(float(t) for t in thresholds))
    levels = edges_below("score", steps, inclusive=True)
    histogram = (
        df.groupBy(*keys, levels.alias("passed"))
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    # One row per key: tp and fp of every threshold as conditional sums.
    reached = ", ".join(
        f"named_struct('threshold', {double(t)}, 'tp', sum(CASE WHEN passed > {k} THEN pos ELSE 0 END), "
        f"'fp', sum(CASE WHEN passed > {k} THEN neg ELSE 0 END))"
        for k, t in enumerate(steps)
    )
    per_key = histogram.groupBy(*keys).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.expr(f"array({reached})").alias("grid")
    )
    cells = per_key.select(*keys, "p", "q", F.inline("grid"))
    counts = cells.withColumns(
        {"fn": F.col("p") - F.col("tp"), "tn": F.col("q") - F.col("fp"), "n": F.col("p") + F.col("q")}
    )
    return counts.withColumns(from_confusion(fp_cost, fn_cost)).drop("p", "q")


# --- metrics of the score itself ----------------------------------------------


def probability_metrics(df: DataFrame, keys: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """Brier score and log-loss (probabilities kept eps away from 0 and 1)."""
    y, p = F.col("y").cast("double"), F.col("score")
    safe = clip(p, eps, 1.0 - eps)
    loss = y * F.log(safe) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - safe)
    return df.groupBy(*keys).agg(
        F.avg((p - y) * (p - y)).alias("brier"), (-F.avg(loss)).alias("log_loss")
    )


def score_counts(
    df: DataFrame, keys: Sequence[str], buckets: int | None = None, predicted: str | None = None
) -> DataFrame:
    """(keys, bucket, score) -> n_pos, n_neg; the input of all ordered metrics.

    With a `predicted` column also hit_pos and hit_neg, the rows decided as 1.
    """
    cuts = range_cuts(df, ["score"], buckets)
    extra = [predicted] if predicted else []
    rows = df.select(*keys, "y", *extra, F.col("score").cast("double").alias("score"))
    placed = with_buckets(rows, cuts).withColumn(
        BUCKET, F.coalesce(F.col("score__bucket").cast("int"), F.lit(0))
    )
    aggregates = {"n_pos": "count_if(y = 1)", "n_neg": "count_if(y = 0)"}
    if predicted:
        aggregates["hit_pos"] = f"count_if(y = 1 AND `{predicted}` = 1)"
        aggregates["hit_neg"] = f"count_if(y = 0 AND `{predicted}` = 1)"
    return placed.groupBy(*keys, BUCKET, "score").agg(*[F.expr(v).alias(k) for k, v in aggregates.items()])


def decision_metrics(
    scored: DataFrame, keys: Sequence[str], predicted: str = "predicted", buckets: int | None = None
) -> DataFrame:
    """accuracy and F1 of a given 0/1 decision, ROC-AUC of the score, in one pass."""
    counts = score_counts(scored, keys, buckets, predicted)
    ranked = running_totals(counts, keys, "score", ["n_pos", "n_neg"])
    aggregates = {
        "tp": "sum(hit_pos)",
        "fp": "sum(hit_neg)",
        "fn": "sum(n_pos - hit_pos)",
        "tn": "sum(n_neg - hit_neg)",
        "n": "sum(n_pos + n_neg)",
        "roc_auc": ORDERED["roc_auc"],
    }
    grouped = ranked.groupBy(*keys).agg(*[F.expr(v).alias(k) for k, v in aggregates.items()])
    return grouped.withColumns(from_confusion()).select(*keys, "accuracy", "f1", "roc_auc")


# Over rows of `running_totals`: negatives below a score win for its positives
# (ties count half); precision at each score, weighted by its positives.
_NEG_BELOW = "(cum_n_neg - n_neg)"
_TP = "(tot_n_pos - (cum_n_pos - n_pos))"
_BOTH = "max(tot_n_pos) > 0 AND max(tot_n_neg) > 0"
WINS = f"double(n_pos) * ({_NEG_BELOW} + n_neg / 2D)"
STEPS = f"double(n_pos) * double({_TP}) / double({_TP} + tot_n_neg - {_NEG_BELOW})"
ORDERED = {
    "roc_auc": f"CASE WHEN {_BOTH} THEN sum({WINS}) / (max(double(tot_n_pos)) * max(double(tot_n_neg))) END",
    "pr_auc": f"CASE WHEN {_BOTH} THEN sum({STEPS}) / max(double(tot_n_pos)) END",
}


def ranking_metrics(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (mid-ranks) and average precision; null with one class only."""
    counts = score_counts(df, keys, buckets)
    ranked = running_totals(counts, keys, "score", ["n_pos", "n_neg"])
    return ranked.groupBy(*keys).agg(*[F.expr(v).alias(k) for k, v in ORDERED.items()])


def reliability_table(
    df: DataFrame, keys: Sequence[str], n_bins: int = C.ECE_BINS, include_zero: bool = False
) -> DataFrame:
    """Per right-closed probability bin: n, mean probability, rate of positives, gap.

    A probability of exactly 0 lies in no bin unless `include_zero`.
    """
    if n_bins <= 1:
        raise ValueError("n_bins must be greater than 1")
    p = clip(F.col("score").cast("double"), 0.0, 1.0)
    bin_id = bin_right_closed("p", equal_edges(n_bins))
    if include_zero:
        bin_id = F.when(bin_id.isNotNull(), F.greatest(bin_id, F.lit(1)))
    binned = df.select(*keys, "y", p.alias("p")).withColumn("bin", bin_id).where(F.col("bin") >= 1)
    return (
        binned.groupBy(*keys, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("p").alias("prob_mean"),
            F.avg(F.col("y").cast("double")).alias("target_rate"),
        )
        .withColumn("abs_gap", F.abs(F.col("prob_mean") - F.col("target_rate")))
    )


def calibration_gap(reliability: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean gap over the filled bins of a reliability table."""
    return reliability.groupBy(*keys).agg(F.avg("abs_gap").alias("mean_abs_gap"))


def calibration_error(
    df: DataFrame, keys: Sequence[str], n_bins: int = C.ECE_BINS, include_zero: bool = False
) -> DataFrame:
    """Expected calibration error per key; rows outside the bins stay in the total.

    n_b/N * |p_b/n_b - y_b/n_b| = |p_b - y_b| / N with the sums p_b, y_b of a bin.
    """
    if n_bins <= 1:
        raise ValueError("n_bins must be greater than 1")
    p = clip(F.col("score").cast("double"), 0.0, 1.0)
    bin_id = bin_right_closed("p", equal_edges(n_bins))
    if include_zero:
        bin_id = F.when(bin_id.isNotNull(), F.greatest(bin_id, F.lit(1)))
    rows = df.select(*keys, F.col("y").cast("double").alias("y"), p.alias("p")).withColumn("bin", bin_id)
    per_bin = rows.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.abs(F.sum("p") - F.sum("y")).alias("gap")
    )
    return per_bin.groupBy(*keys).agg(
        F.expr("coalesce(try_divide(sum(CASE WHEN bin >= 1 THEN gap ELSE 0D END), sum(n)), 0D)").alias("ece")
    )


def metric_record(
    df: DataFrame,
    keys: Sequence[str],
    threshold: float = 0.5,
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
    n_bins: int = C.ECE_BINS,
    eps: float = 1e-6,
    buckets: int | None = None,
) -> DataFrame:
    """Every metric of scored rows per key, from one set of per-score counts.

    Scores are clipped to [0, 1]. All metrics are functions of
    (score, positives, negatives), so the rows are shuffled once, already counted;
    sums per probability bin are then folded into one row per key.
    """
    clipped = df.withColumn("score", clip(F.col("score").cast("double"), 0.0, 1.0))
    counts = score_counts(clipped, keys, buckets)
    ranked = running_totals(counts, keys, "score", ["n_pos", "n_neg"])
    ranked = ranked.withColumn("bin", bin_right_closed("score", equal_edges(n_bins)))
    hit = f"score >= {double(threshold)}"
    safe = f"least(greatest(score, {double(eps)}), {double(1.0 - eps)})"
    per_bin = {
        "tp": f"sum(CASE WHEN {hit} THEN n_pos ELSE 0 END)",
        "fp": f"sum(CASE WHEN {hit} THEN n_neg ELSE 0 END)",
        "pos": "sum(n_pos)",
        "neg": "sum(n_neg)",
        "square": "sum(n_pos * (1D - score) * (1D - score) + n_neg * score * score)",
        "loss": f"sum(n_pos * ln({safe}) + n_neg * ln(1D - {safe}))",
        "gap": "abs(sum((n_pos + n_neg) * score) - sum(n_pos))",
        "wins": f"sum({WINS})",
        "steps": f"sum({STEPS})",
    }
    binned = ranked.groupBy(*keys, "bin").agg(*[F.expr(v).alias(k) for k, v in per_bin.items()])
    folded = binned.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "pos", "neg", "square", "loss", "wins", "steps")],
        F.expr("sum(CASE WHEN bin >= 1 THEN gap ELSE 0D END)").alias("gap"),
    )
    record = folded.selectExpr(
        *keys,
        "tp",
        "fp",
        "pos - tp AS fn",
        "neg - fp AS tn",
        "pos + neg AS n",
        "square / (pos + neg) AS brier",
        "-loss / (pos + neg) AS log_loss",
        "coalesce(try_divide(gap, pos + neg), 0D) AS ece",
        "CASE WHEN pos > 0 AND neg > 0 THEN wins / (double(pos) * double(neg)) END AS roc_auc",
        "CASE WHEN pos > 0 AND neg > 0 THEN steps / double(pos) END AS pr_auc",
    )
    return record.withColumns(from_confusion(fp_cost, fn_cost))


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metric columns -> rows (ids, metric, value)."""
    typed = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot(list(ids), list(metrics), "metric", "value")


def to_wide(
    df: DataFrame, ids: Sequence[str], split: str, splits: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Rows per split -> columns `<split>_<metric>` (mean over repeats).

    The pivot values are given, so no job runs to find them.
    """
    cells = [
        F.avg(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}") for s in splits for m in metrics
    ]
    return df.groupBy(*ids).agg(*cells)
