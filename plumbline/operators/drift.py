"""Drift of feature distributions between a reference and later windows.

All windows and features are handled in one job: numeric cells are counted per
(window, feature, value) and every statistic is read off those counts. The sup of
|F_ref - F_window| is reached at, or just before, a value of the window, so the
reference is never repeated per window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline import constants as C
from plumbline.functions import (
    MISSING,
    bin_left_closed_sql,
    chi2_upper_tail,
    double,
    is_close,
    kolmogorov_upper_tail,
    number,
)
from plumbline.operators.ordered import (
    BUCKET,
    bucket_sql,
    buckets_for,
    collect_quantiles,
    range_cuts,
    running_totals,
    with_buckets,
)
from plumbline.session import default_buckets

WINDOW = ("window_id", "scenario")
# Reference and windows travel in one table; `is_ref` tells them apart, whatever the ids are.
SIDE = ("is_ref", *WINDOW)


@dataclass(frozen=True)
class ReferenceProfile:
    """What is fitted once: range cuts and bin edges of the numeric features.

    Its size is (features x (buckets + bins)) numbers, whatever the table size.
    """

    cuts: Mapping[str, Sequence[float]]
    edges: Mapping[str, Sequence[float]]

    @property
    def flat(self) -> list[str]:
        """Features whose quantile edges collapse; they get equal-width bins."""
        return [f for f, e in self.edges.items() if len(e) < 3]


def fit_reference(
    reference: DataFrame,
    numeric: Sequence[str],
    windows: DataFrame | None = None,
    bins: int = C.PSI_BINS,
    buckets: int | None = None,
    digits: int | None = None,
) -> ReferenceProfile:
    """Quantile edges of the reference; cuts balanced over reference and windows.

    `digits` rounds the inner edges, so that profiles fitted by engines that
    interpolate differently in the last bit agree. The outer edges stay exact.
    """
    if not numeric:
        return ReferenceProfile({}, {})
    sample = reference.select(*numeric)
    if windows is not None:
        sample = sample.unionByName(windows.select(*numeric))
    buckets = buckets or buckets_for(sample.sparkSession, sample.count())
    cuts = range_cuts(sample, numeric, buckets)
    probs = [k / bins for k in range(bins + 1)]
    found = collect_quantiles(reference, numeric, probs, cuts)

    return ReferenceProfile(cuts, {f: distinct_edges(found.get(f, []), digits) for f in numeric})


def distinct_edges(quantiles: Sequence[float], digits: int | None = None) -> list[float]:
    """Ascending edges without repetition; inner ones rounded if digits are given."""
    inner = quantiles[1:-1] if digits is None else [round(x, digits) for x in quantiles[1:-1]]
    return sorted({quantiles[0], *inner, quantiles[-1]}) if quantiles else []


def _reference_only(reference: DataFrame, columns: Sequence[str], id_type: str = "bigint") -> DataFrame:
    return reference.select(
        F.lit(True).alias("is_ref"),
        F.lit(None).cast(id_type).alias("window_id"),
        F.lit("reference").alias("scenario"),
        *columns,
    )


def _stack(reference: DataFrame, windows: DataFrame, columns: Sequence[str]) -> DataFrame:
    id_type = dict(windows.dtypes)["window_id"]
    return _reference_only(reference, columns, id_type).unionByName(
        windows.select(F.lit(False).alias("is_ref"), *WINDOW, *columns)
    )


def _numeric_cells(stacked: DataFrame, profile: ReferenceProfile) -> DataFrame:
    """Long rows (window, feature, value, bucket, bin); null values are kept."""
    features = list(profile.edges)
    typed = stacked.select(*SIDE, *[number(F.col(f)).alias(f) for f in features])
    placed = with_buckets(typed, {f: profile.cuts[f] for f in features})
    cells = []
    for f in features:
        edges = profile.edges[f]
        bin_id = bin_left_closed_sql(f"`{f}`", edges) if len(edges) >= 3 else "int(NULL)"
        cells.append(f"named_struct('feature', '{f}', 'value', `{f}`, {bucket_sql(f)}, 'bin', {bin_id})")
    return placed.select(*SIDE, F.expr(f"inline(array({', '.join(cells)}))"))


def _numeric_counts(cells: DataFrame) -> DataFrame:
    """Null cells stay as one row with n = 0, so every (window, feature) survives."""
    return cells.groupBy(*SIDE, "feature", BUCKET, "bin", "value").agg(F.count("value").alias("n"))


def _bin_columns(prefix: str, bins: int) -> list[Column]:
    return [F.expr(f"sum(CASE WHEN bin = {k} THEN n ELSE 0 END)").alias(f"{prefix}{k}") for k in range(bins)]


def _psi_sql(ref: str, cur: str, ref_total: str, cur_total: str) -> str:
    r = f"greatest(double({ref}) / {ref_total}, {double(C.PSI_FLOOR)})"
    c = f"greatest(double({cur}) / {cur_total}, {double(C.PSI_FLOOR)})"
    return f"({c} - {r}) * ln({c} / {r})"


def numeric_drift(
    reference: DataFrame, windows: DataFrame, profile: ReferenceProfile, bins: int = C.PSI_BINS
) -> DataFrame:
    """(window_id, scenario, feature, n_ref, n_cur, ks, psi) of the profiled features."""
    stacked = _stack(reference, windows, list(profile.edges))
    return numeric_drift_of_counts(_numeric_counts(_numeric_cells(stacked, profile)), profile, bins)


def numeric_drift_of_counts(counts: DataFrame, profile: ReferenceProfile, bins: int = C.PSI_BINS) -> DataFrame:
    """As `numeric_drift`, from counted values (is_ref, window_id, scenario, feature, bucket, bin, value, n).

    A null value with n = 0 keeps a (window, feature) without values in the result.
    """
    is_ref = F.col("is_ref")
    ref_n = F.when(is_ref, F.col("n")).otherwise(F.lit(0))

    # Totals per bucket: at most windows x features x buckets rows.
    totals = counts.groupBy(*SIDE, "feature", BUCKET).agg(F.sum("n").alias("n"))
    own = W.partitionBy(*SIDE, "feature")
    offsets = totals.select(
        *SIDE,
        "feature",
        BUCKET,
        F.coalesce(
            F.sum("n").over(own.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("n"),
        F.sum("n").over(own).alias("n_cur"),
    )
    # The reference's own sums per (feature, bucket), over its buckets only.
    ref_totals = totals.groupBy("feature", BUCKET).agg(F.sum(ref_n).alias("n"))
    across = W.partitionBy("feature")
    upto_bucket = across.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    # Head rows sort first in their bucket and carry the sums of earlier buckets:
    # one per (window, feature, bucket), and one per (feature, bucket) for the
    # reference, which may have no value of its own there.
    window_heads = offsets.select(
        *SIDE, "feature", BUCKET, "n", F.lit(0).cast("bigint").alias("rn"), "n_cur"
    )
    ref_heads = ref_totals.select(
        "feature",
        BUCKET,
        F.coalesce(F.sum("n").over(upto_bucket), F.lit(0)).alias("rn"),
        F.sum("n").over(across).alias("n_ref"),
        F.lit(True).alias("is_ref"),
        F.lit(None).cast(dict(counts.dtypes)["window_id"]).alias("window_id"),
        F.lit("reference").alias("scenario"),
        F.lit(0).cast("bigint").alias("n"),
    )
    heads = window_heads.unionByName(ref_heads, allowMissingColumns=True).withColumn("head", F.lit(1))
    rows = counts.withColumns({"rn": ref_n, "head": F.lit(0)}).unionByName(heads, allowMissingColumns=True)
    # Many buckets are more than the cluster's shuffle width would keep apart.
    widest = max((len(c) + 1 for c in profile.cuts.values()), default=1)
    if widest > default_buckets(counts.sparkSession):
        rows = rows.repartition(widest, "feature", BUCKET)

    # Among equal values the reference row comes first, so its sum is complete
    # there, and the last reference row seen tells its count at this value.
    order = [F.col("head").desc(), F.col("value")]
    upto = (
        W.partitionBy("feature", BUCKET)
        .orderBy(*order, is_ref.desc())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    ref_row = F.when(is_ref & (F.col("head") == 0), F.struct(F.col("value").alias("v"), F.col("n").alias("n")))
    mine = W.partitionBy("feature", BUCKET, *SIDE).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.select(
        *SIDE,
        "feature",
        "head",
        "bin",
        "value",
        "n",
        F.sum("rn").over(upto).alias("ref_upto"),
        F.sum("n_ref").over(upto).alias("n_ref"),
        F.last(ref_row, ignorenulls=True).over(upto).alias("ref_last"),
        F.sum("n").over(mine).alias("cur_upto"),
        F.sum("n_cur").over(mine).alias("n_cur"),
    ).where((F.col("head") == 0) & ~is_ref)
    ref_at = "CASE WHEN ref_last.v = value THEN ref_last.n ELSE 0 END"
    # Without a reference value there is no distance: null, and 0 in the result.
    n_ref, n_cur = "double(nullif(n_ref, 0))", "double(nullif(n_cur, 0))"
    at_value = f"abs(ref_upto / {n_ref} - cur_upto / {n_cur})"
    before = f"abs((ref_upto - {ref_at}) / {n_ref} - (cur_upto - n) / {n_cur})"
    # First per bin, then per feature: few aggregates touch the many rows.
    per_bin = placed.groupBy(*WINDOW, "feature", "bin").agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        F.expr(f"max(CASE WHEN n > 0 THEN greatest({at_value}, {before}) END)").alias("ks"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("n").alias("n"),
    )
    per_feature = per_bin.groupBy(*WINDOW, "feature").agg(
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
        F.max("ks").alias("ks"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *_bin_columns("b", bins),
    )
    # The reference needs no order, only its bins: they are in the counts already, and
    # come to one row per feature column of the table, a bound known before the job runs.
    ref_bins = (
        counts.where(is_ref)
        .groupBy("feature")
        .agg(F.min("value").alias("ref_low"), F.max("value").alias("ref_high"), *_bin_columns("r", bins))
    )
    paired = per_feature.join(F.broadcast(ref_bins), "feature").selectExpr(
        "*",
        " + ".join(f"r{k}" for k in range(bins)) + " AS ref_binned",
        " + ".join(f"b{k}" for k in range(bins)) + " AS cur_binned",
    )
    psi = " + ".join(_psi_sql(f"r{k}", f"b{k}", "ref_binned", "cur_binned") for k in range(bins))
    result = paired.selectExpr(
        *WINDOW,
        "feature",
        "n_ref",
        "n_cur",
        "coalesce(ks, 0D) AS ks",
        f"CASE WHEN ref_binned > 0 AND cur_binned > 0 THEN {psi} ELSE 0D END AS psi",
        "least(low, ref_low) AS low",
        "greatest(high, ref_high) AS high",
    )
    if profile.flat:
        result = _with_flat_psi(result, counts, profile, bins)
    return result.drop("low", "high")


def _with_flat_psi(
    result: DataFrame, counts: DataFrame, profile: ReferenceProfile, bins: int
) -> DataFrame:
    """PSI of features with collapsed edges: equal bins over the joint range.

    The range differs per window. Its inner edges enter the reference's ordered counts
    as probe rows that sort before equal values; the running sum there is the number of
    reference values below the edge, so no reference value is repeated per window.
    """
    flat = profile.flat
    cells = counts.where(F.col("feature").isin(flat) & F.col("value").isNotNull())
    ranges = result.where(F.col("feature").isin(flat)).select(*WINDOW, "feature", "low", "high", "n_ref")
    width = f"((high - low) / {double(bins)})"
    edge = [f"named_struct('k', {k}, 'edge', low + {double(k)} * {width})" for k in range(1, bins)]
    probes = ranges.select(*WINDOW, "feature", F.expr(f"inline(array({', '.join(edge)}))"))
    cuts = F.create_map(*[F.lit(x) if i % 2 == 0 else F.array(*map(F.lit, x)).cast("array<double>") for f in flat for i, x in enumerate((f, list(profile.cuts[f])))])
    bucket = F.size(F.filter(cuts[F.col("feature")], lambda c: c <= F.col("edge")))
    kind = lambda value, order: F.struct(value.alias("value"), F.lit(order).alias("kind")).alias("place")
    asked = probes.select(*WINDOW, "feature", "k", bucket.alias(BUCKET), kind(F.col("edge"), 0), F.lit(0).cast("bigint").alias("n"))
    known = cells.where(F.col("is_ref")).select("feature", BUCKET, kind(F.col("value"), 1), "n")
    below = running_totals(asked.unionByName(known, allowMissingColumns=True), ["feature"], "place", ["n"]).where(F.col("k").isNotNull())
    names = [f"e{k}" for k in range(1, bins)]
    ref = below.groupBy(*WINDOW, "feature").agg(*[F.max(F.when(F.col("k") == k, F.col("cum_n"))).alias(f"e{k}") for k in range(1, bins)])
    at = " + ".join(f"int(value >= low + {double(k)} * {width})" for k in range(1, bins))
    own = cells.where(~F.col("is_ref")).drop("bin").join(ranges.drop("n_ref"), [*WINDOW, "feature"]).withColumn("bin", F.expr(at))
    cur = own.groupBy(*WINDOW, "feature").agg(*_bin_columns("b", bins), F.sum("n").alias("cur_all"))
    upto = ["0", *names, "n_ref"]
    term = " + ".join(_psi_sql(f"({upto[k + 1]} - {upto[k]})", f"b{k}", "n_ref", "cur_all") for k in range(bins))
    terms = ref.join(cur, [*WINDOW, "feature"]).join(ranges, [*WINDOW, "feature"])
    terms = terms.select(*WINDOW, "feature", F.expr(f"CASE WHEN n_ref > 0 AND cur_all > 0 THEN {term} END").alias("flat_psi"))
    merged = result.join(terms, [*WINDOW, "feature"], "left")
    spread = ~is_close(F.col("low"), F.col("high"))
    psi = F.when(F.col("feature").isin(flat), F.coalesce(F.when(spread, F.col("flat_psi")), F.lit(0.0))).otherwise(
        F.col("psi")
    )
    return merged.withColumn("psi", psi).drop("flat_psi")


def _levels(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    cells = ", ".join(
        f"named_struct('feature', '{f}', 'level', coalesce(string(`{f}`), '{MISSING}'))" for f in features
    )
    long = df.select(*keys, F.expr(f"inline(array({cells}))"))
    return long.groupBy(*keys, "feature", "level").agg(F.count(F.lit(1)).alias("n"))


def categorical_drift(reference: DataFrame, windows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(window_id, scenario, feature, levels, chi2, df, psi) over the union of levels."""
    return categorical_drift_of_counts(_levels(reference, [], features), _levels(windows, WINDOW, features))


def categorical_drift_of_counts(reference: DataFrame, windows: DataFrame) -> DataFrame:
    """As `categorical_drift`, from counts (feature, level, n) and (window_id, scenario, feature, level, n).

    Null is the level 'missing'. Two levels get the continuity correction. A window is
    joined to the reference only on the levels that it has: what a level missing from it
    adds to each sum depends on the reference count alone, so those parts are the sums
    over all reference levels less the sums over the shared ones.
    """
    floor = double(C.PSI_FLOOR)
    alone = f"({floor} - greatest(r / nr, {floor})) * ln({floor} / greatest(r / nr, {floor}))"
    ref = reference.selectExpr("feature", "level", "double(n) AS r")
    sizes = ref.groupBy("feature").agg(F.sum("r").alias("nr"), F.count(F.lit(1)).alias("ref_levels"), F.expr("sum(1D / r)").alias("ref_inverse"))
    alone_sums = ref.join(sizes, "feature").groupBy("feature").agg(F.expr(f"sum({alone})").alias("ref_alone"))
    ref_sums = sizes.join(alone_sums, "feature")
    cur = windows.selectExpr(*WINDOW, "feature", "level", "double(n) AS c")
    cur_sizes = cur.groupBy(*WINDOW, "feature").agg(F.sum("c").alias("nc"))
    pairs = cur_sizes.join(ref_sums, "feature")
    table = cur.join(ref, ["feature", "level"], "left").join(pairs, [*WINDOW, "feature"]).withColumn("shared", F.col("r").isNotNull())
    table = table.withColumn("r", F.coalesce("r", F.lit(0.0)))
    found = table.groupBy(*WINDOW, "feature").agg(
        *[F.max(c).alias(c) for c in ("nr", "nc", "ref_levels", "ref_inverse", "ref_alone")],
        F.count_if(~F.col("shared")).alias("new_levels"),
        F.sum("r").alias("shared_r"),
        F.expr("sum(CASE WHEN shared THEN 1D / r ELSE 0D END)").alias("shared_inverse"),
        F.expr(f"sum(CASE WHEN shared THEN {alone} ELSE 0D END)").alias("shared_alone"),
        F.expr("sum(pow(r * nc - c * nr, 2D) / (nr * nc * (r + c)))").alias("own_chi2"),
        F.expr("sum(1D / (r + c))").alias("own_inverse"),
        F.expr("max(abs(r * nc - c * nr) / (nr + nc))").alias("off"),
        F.expr(f"sum({_psi_sql('r', 'c', 'nr', 'nc')})").alias("own_psi"),
    )
    # With two levels the distance from the expected count is the same in all four cells.
    yates = (
        "pow(off - least(0.5D, off), 2D) * (own_inverse + ref_inverse - shared_inverse) * ((nr + nc) / nr + (nr + nc) / nc)"
    )
    return found.selectExpr(
        *WINDOW,
        "feature",
        "ref_levels + new_levels AS levels",
        f"CASE WHEN ref_levels + new_levels = 2 THEN {yates} ELSE own_chi2 + nc / nr * (nr - shared_r) END AS chi2",
        "ref_levels + new_levels - 1 AS df",
        "own_psi + ref_alone - shared_alone AS psi",
    )


def drift_flag(p_value: Column, psi: Column, alpha: float = C.ALPHA, psi_alert: float = C.PSI_ALERT) -> Column:
    return (p_value < alpha) | (psi >= psi_alert)


def drift_severity(psi: Column, warn: float = C.PSI_WARN, alert: float = C.PSI_ALERT) -> Column:
    return F.when(psi >= alert, F.lit("alert")).when(psi >= warn, F.lit("warn")).otherwise(F.lit("stable"))


def drift_audit(
    reference: DataFrame,
    windows: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    dataset: str = "dataset",
    alpha: float = C.ALPHA,
    psi_alert: float = C.PSI_ALERT,
    profile: ReferenceProfile | None = None,
) -> DataFrame:
    """Every window x feature in the shape of the drift audit table.

    `windows` has window_id, scenario and the features; `reference` the features.
    """
    if numeric:
        profile = profile or fit_reference(reference, numeric, windows)
    return audit_table(
        numeric_drift(reference, windows, profile) if numeric else None,
        categorical_drift(reference, windows, categorical) if categorical else None,
        dataset,
        alpha,
        psi_alert,
    )


def audit_table(
    numeric: DataFrame | None,
    categorical: DataFrame | None,
    dataset: str = "dataset",
    alpha: float = C.ALPHA,
    psi_alert: float = C.PSI_ALERT,
) -> DataFrame:
    """The drift audit table of the results of `numeric_drift` and `categorical_drift`."""
    parts = []
    if numeric is not None:
        known = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
        p = F.when(known, kolmogorov_upper_tail("ks", "n_ref", "n_cur")).otherwise(F.lit(1.0))
        parts.append(
            numeric.select(
                *WINDOW,
                "feature",
                F.lit("numeric").alias("feature_type"),
                F.lit("ks").alias("detector"),
                F.col("ks").alias("statistic"),
                p.alias("p_value"),
                F.col("psi").alias("effect_size"),
            )
        )
    if categorical is not None:
        parts.append(
            categorical.select(
                *WINDOW,
                "feature",
                F.lit("categorical").alias("feature_type"),
                F.lit("chi2").alias("detector"),
                F.col("chi2").alias("statistic"),
                chi2_upper_tail("chi2", "df").alias("p_value"),
                F.col("psi").alias("effect_size"),
            )
        )
    if not parts:
        raise ValueError("drift_audit needs at least one feature")
    audit = parts[0]
    for more in parts[1:]:
        audit = audit.unionByName(more)
    flagged = audit.withColumns(
        {
            "dataset": F.lit(dataset),
            "drift_flag": drift_flag(F.col("p_value"), F.col("effect_size"), alpha, psi_alert),
        }
    )
    return flagged.select(*C.DRIFT_COLUMNS)
