"""Error audits by segment of one feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from plumbline import constants as C
from plumbline.functions import MISSING, bin_right_closed, category, interval_text
from plumbline.operators.metrics import confusion_counts, from_confusion
from plumbline.operators.ordered import feature_quantiles


def quantile_edges(
    df: DataFrame, feature: str, n_bins: int = 4, digits: int | None = None
) -> list[float]:
    """De-duplicated quantile edges; fewer bins when there are few distinct values.

    The number of distinct values comes with the quantiles; only a column with fewer
    than `n_bins` of them is asked again.
    """
    wanted = max(2, n_bins)

    def asked(bins: int):
        return feature_quantiles(df, [feature], [k / bins for k in range(bins + 1)], digits=digits).first()

    found = asked(wanted)
    if found is None or found["n_values"] < 2:
        return []
    if found["n_values"] < wanted:
        found = asked(found["n_values"])
    return sorted(set(found["quantiles"]))


def segment_columns(df: DataFrame, feature: str, n_bins: int = 4) -> DataFrame:
    """Add segment, segment_lo, segment_hi: quantile bins (lo, hi] or the category.

    The lowest edge belongs to the first bin. Nulls form the segment 'missing'.
    """
    kind = df.schema[feature].dataType
    none = F.lit(None).cast("double")
    if not isinstance(kind, (NumericType, BooleanType)):
        return df.withColumns({"segment": category(F.col(feature)), "segment_lo": none, "segment_hi": none})
    edges = quantile_edges(df, feature, n_bins)
    if len(edges) < 2:
        return df.withColumns({"segment": F.lit("all"), "segment_lo": none, "segment_hi": none})
    # The lowest value belongs to the first bin (and rounded edges may miss the extremes).
    inner = bin_right_closed(f"double(`{feature}`)", edges)
    bin_id = F.when(inner.isNotNull(), F.least(F.greatest(inner, F.lit(1)), F.lit(len(edges) - 1)))
    lows = F.array(*[F.lit(e) for e in edges[:-1]])
    highs = F.array(*[F.lit(e) for e in edges[1:]])
    lo, hi = F.try_element_at(lows, bin_id), F.try_element_at(highs, bin_id)
    # The first label is lowered a little to show that its left edge is inside.
    shown = F.when(bin_id == 1, lo - F.lit(0.001)).otherwise(lo)
    label = F.coalesce(F.when(bin_id.isNotNull(), interval_text(shown, hi)), F.lit(MISSING))
    return df.withColumns({"segment": label, "segment_lo": lo, "segment_hi": hi})


def segment_errors(
    df: DataFrame,
    feature: str,
    keys: Sequence[str] = (),
    n_bins: int = 4,
    y: str = "y",
    predicted: str = "predicted",
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
) -> DataFrame:
    """Per segment: n, error, false-positive and false-negative share, cost per 100."""
    marked = segment_columns(df, feature, n_bins)
    counts = confusion_counts(marked, [*keys, "segment", "segment_lo", "segment_hi"], y, predicted)
    rates: dict[str, Column] = from_confusion(fp_cost, fn_cost)
    return counts.select(
        *keys,
        F.lit(feature).alias("segment_feature"),
        "segment",
        "segment_lo",
        "segment_hi",
        "n",
        rates["error_rate"].alias("error_rate"),
        rates["fp_rate"].alias("false_positive_rate"),
        rates["fn_rate"].alias("false_negative_rate"),
        rates["cost_per_100"].alias("expected_cost_per_100"),
    )


def segment_policy_audit(
    df: DataFrame,
    feature: str,
    dataset: str,
    n_bins: int = 4,
    fp_cost: float = C.FP_COST,
    fn_cost: float = C.FN_COST,
) -> DataFrame:
    """The segment table in the shape of the policy audit."""
    table = segment_errors(df, feature, (), n_bins, fp_cost=fp_cost, fn_cost=fn_cost)
    return table.select(
        F.lit(dataset).alias("dataset"),
        "segment_feature",
        "segment",
        "n",
        F.col("false_positive_rate").alias("fp_rate"),
        F.col("false_negative_rate").alias("fn_rate"),
        "expected_cost_per_100",
    )
