"""Drift audits from mergeable states.

A state is the count of one value (numeric) or level (categorical) of one feature in one
period. Counts add up, so a window of any periods, overlapping or not, is the sum of their
states, and raw rows of a period are read once, when its states are written. Everything an
audit needs (quantile edges, KS, PSI, chi-square) follows from counts and is exact.

A state table holds one row per (period, feature, distinct value): far fewer than cells for
codes, amounts in cents or levels, about as many for measurements that never repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import constants as C
from plumbline.functions import MISSING, bin_left_closed_sql, number
from plumbline.operators import drift as D
from plumbline.operators.ordered import BUCKET, accuracy, buckets_for, quantiles_from_totals, running_totals, with_buckets
from plumbline.session import broadcast_few, default_buckets, partitions_for, shuffle_width, stage

SCHEMA = "feature string, kind string, value double, level string, n bigint, period date"
KEYS = ("feature", "kind", "value", "level")


def period_states(
    rows: DataFrame, period: Column, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> DataFrame:
    """Counts (period, feature, kind, value, level, n) of the rows, in one pass and one exchange.

    `period` is a date. A null number (also NaN, or text that is none) is counted as a row
    without a value, a null category as the level 'missing'. Rows without a period are an
    error, as no window could ever reach them.
    """
    if not (numeric or categorical):
        raise ValueError("states need at least one feature")
    clash = set(numeric) & set(categorical)
    if clash:
        raise ValueError(f"numeric and categorical at once: {sorted(clash)}")
    cell = lambda f, kind, value, level: F.struct(
        F.lit(f).alias("feature"), F.lit(kind).alias("kind"), value.alias("value"), level.alias("level")
    )
    no_value, no_level = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [cell(f, "numeric", number(F.col(f)), no_level) for f in numeric]
    cells += [
        cell(f, "categorical", no_value, F.coalesce(F.col(f).cast("string"), F.lit(MISSING))) for f in categorical
    ]
    day = period.cast("date")
    known = F.when(day.isNull(), F.raise_error(F.lit("a row has no period"))).otherwise(day)
    long = rows.select(known.cast("date").alias("period"), F.inline(F.array(*cells)))
    return long.groupBy("period", *KEYS).agg(F.count(F.lit(1)).alias("n"))


def write_states(states: DataFrame, path: str, partitions: int | None = None) -> None:
    """Add the periods of `states` to the table at `path`, one folder each.

    Periods written before are replaced and others stay, so a period that is counted again
    (late rows, a failed job) is never counted twice. A rebalancing exchange keeps a period in
    few files and splits a large one. `partitions` (`session.partitions_for` the counted rows)
    keeps what one task counts bounded; without it the session's shuffle width is used.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    spark = states.sparkSession
    with shuffle_width(spark, partitions) if partitions else nullcontext():
        (
            states.select(*names)
            .hint("rebalance", "period")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("period")
            .parquet(path)
        )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The state table; filters on `period` prune folders."""
    return spark.read.schema(SCHEMA).parquet(path)


def _merged(states: DataFrame, calendar: DataFrame, partitions: int) -> DataFrame:
    """Counts per side, window and value, of the periods that a staged calendar lists.

    The calendar goes to the states: a join by period would send a whole period to one task.
    States of a period are counted already, so they are dealt out before they are added up.
    """
    placed = states.join(broadcast_few(calendar), "period")
    dealt = placed.repartition(partitions, *D.SIDE, *KEYS)
    return dealt.groupBy(*D.SIDE, *KEYS).agg(F.sum("n").alias("n"))


def fit_reference_states(
    counts: DataFrame, bins: int = C.PSI_BINS, buckets: int | None = None, digits: int | None = None
) -> D.ReferenceProfile:
    """The profile that `drift.fit_reference` finds on raw rows, from merged counts (is_ref, feature, value, n).

    Cuts balance counted values rather than rows, since counted values are what an audit sorts.
    """
    buckets = buckets or default_buckets(counts.sparkSession)
    shares = [k / buckets for k in range(1, buckets)]
    found = counts.groupBy("feature").agg(F.percentile_approx("value", shares, accuracy(buckets)).alias("cuts")).collect()
    cuts = {r["feature"]: sorted(set(r["cuts"] or [])) for r in found}
    known = _with_bucket(counts.where("is_ref AND value IS NOT NULL"), cuts)
    ranked = running_totals(known.select("feature", BUCKET, "value", "n"), ["feature"], "value", ["n"])
    quantiles = quantiles_from_totals(ranked, ["feature"], [k / bins for k in range(bins + 1)])
    edges = {r["feature"]: r["quantiles"] for r in quantiles.collect()}
    return D.ReferenceProfile(cuts, {f: D.distinct_edges(edges.get(f, []), digits) for f in cuts})


def _with_bucket(counts: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Range bucket of long rows: the value stands in its feature's column, null in the others."""
    names = {f"__{i}": f for i, f in enumerate(cuts)}
    wide = counts.withColumns({c: F.when(F.col("feature") == f, F.col("value")) for c, f in names.items()})
    placed = with_buckets(wide, {c: cuts[f] for c, f in names.items()})
    bucket = F.coalesce(
        *[F.when(F.col("feature") == f, F.col(f"{c}__bucket").cast("int")) for c, f in names.items()], F.lit(0)
    )
    return placed.withColumn(BUCKET, bucket).drop(*names, *[f"{c}__bucket" for c in names])


def _bin(profile: D.ReferenceProfile) -> Column:
    """Bin of long rows by the edges of their feature; null outside and for flat features."""
    found = F.lit(None).cast("int")
    for f, edges in profile.edges.items():
        if len(edges) >= 3:
            found = F.when(F.col("feature") == f, F.expr(bin_left_closed_sql("value", edges))).otherwise(found)
    return found.cast("int")


def drift_audit_of_states(
    states: DataFrame,
    reference: DataFrame,
    windows: DataFrame,
    dataset: str = "dataset",
    alpha: float = C.ALPHA,
    psi_alert: float = C.PSI_ALERT,
    digits: int | None = None,
) -> DataFrame:
    """The rows of `drift.drift_audit`, from states alone.

    `reference` lists the periods (period) of the reference, `windows` those of each window
    (window_id, scenario, period); a period may be in many windows. Listed twice in one
    window, it counts once. Both lists are calendars, of one row per period and window, and
    grow with neither rows nor values. States of the reference are merged once, however many
    windows there are; a window's states are merged and written (`session.stage`) before they
    are compared, since edges and statistics both read them.
    """
    id_type = dict(windows.dtypes)["window_id"]
    calendar = windows.select(F.lit(False).alias("is_ref"), *D.WINDOW, "period").unionByName(
        reference.select(
            F.lit(True).alias("is_ref"),
            F.lit(None).cast(id_type).alias("window_id"),
            F.lit("reference").alias("scenario"),
            "period",
        )
    )
    spark = states.sparkSession
    listed = stage(calendar.distinct(), "calendar")
    most = listed.groupBy("period").count().agg(F.max("count")).first()[0] or 0
    partitions = partitions_for(spark, states.count() * most)
    with shuffle_width(spark, partitions):
        counts = stage(_merged(states, listed, partitions), "window-states")
    kinds = {r["kind"] for r in counts.select("kind").distinct().collect()}
    numeric = categorical = None
    if "numeric" in kinds:
        values = counts.where("kind = 'numeric'").select(
            *D.SIDE, "feature", "value", F.when(F.col("value").isNull(), 0).otherwise(F.col("n")).alias("n")
        )
        rows = counts.count()
        with shuffle_width(spark, partitions_for(spark, rows)):
            profile = fit_reference_states(values, buckets=buckets_for(spark, rows), digits=digits)
            if profile.edges:
                placed = _with_bucket(values, profile.cuts).withColumn("bin", _bin(profile))
                numeric = stage(D.numeric_drift_of_counts(placed, profile), "numeric-drift")
    if "categorical" in kinds:
        levels = counts.where("kind = 'categorical'")
        categorical = D.categorical_drift_of_counts(
            levels.where("is_ref").select("feature", "level", "n"),
            levels.where("NOT is_ref").select(*D.WINDOW, "feature", "level", "n"),
        )
    return D.audit_table(numeric, categorical, dataset, alpha, psi_alert)
