"""Rankings of features and the sets built from them.

These tables have one row per (dataset, method, feature): their size is the number
of feature columns, so windows per dataset and method stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from plumbline import constants as C
from plumbline.functions import tidy


def rank_scores(scores: DataFrame, keys: Sequence[str], tie_digits: int | None = None) -> DataFrame:
    """Ordinal rank, 1 = highest score; equal scores by feature name.

    `tie_digits` treats scores that agree so far as equal.
    """
    value = F.col("score") if tie_digits is None else F.round("score", tie_digits)
    order = W.partitionBy(*keys).orderBy(value.desc(), F.col("feature"))
    return scores.withColumn("rank", F.row_number().over(order))


def ranking_table(scores: DataFrame, method: str, dataset: str | None = None, tie_digits: int | None = None) -> DataFrame:
    """Scores of one method in the shape of the ranking table."""
    named = scores.withColumn("method", F.lit(method))
    if dataset is not None:
        named = named.withColumn("dataset", F.lit(dataset))
    return rank_scores(named, ["dataset", "method"], tie_digits).select(*C.RANKING_COLUMNS)


def importance_rows(
    scores: DataFrame, dataset: str | None, model: str, feature_set: str, method: str
) -> DataFrame:
    """Global importance rows, ready to be united and ranked; without a name `dataset` is a column."""
    return scores.select(
        F.col("dataset") if dataset is None else F.lit(dataset).alias("dataset"),
        F.lit(model).alias("model"),
        F.lit(feature_set).alias("feature_set"),
        F.lit(method).alias("method"),
        "feature",
        F.col("score").cast("double").alias("score"),
    )


def rank_importance(rows: DataFrame) -> DataFrame:
    return rank_scores(rows, ["dataset", "model", "feature_set", "method"])


def top_k(ranking: DataFrame, k: int, keys: Sequence[str] = ("dataset", "method")) -> DataFrame:
    """The k best rows of each group by rank."""
    order = W.partitionBy(*keys).orderBy("rank", "feature")
    return ranking.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def shortlist(
    ranking: DataFrame, methods: Sequence[str] = C.FILTER_METHODS, top_n: int = 12, fallback: bool = True
) -> DataFrame:
    """(dataset, feature, mean_rank, place): lowest mean rank over the methods.

    A dataset without any of the methods falls back to all methods it has.
    """
    chosen = F.col("method").isin(list(methods))
    if fallback:
        has = F.max(chosen.cast("int")).over(W.partitionBy("dataset"))
        pool = ranking.withColumn("__has", has).where(chosen | (F.col("__has") == 0))
    else:
        pool = ranking.where(chosen)
    means = pool.groupBy("dataset", "feature").agg(F.avg("rank").alias("mean_rank"))
    order = W.partitionBy("dataset").orderBy("mean_rank", "feature")
    return means.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top_n)


def method_support(ranking: DataFrame, methods: Sequence[str], k: int = 10) -> DataFrame:
    """(dataset, feature, support, n_methods): in how many top-k lists a feature is."""
    top = top_k(ranking.where(F.col("method").isin(list(methods))), k)
    present = top.groupBy("dataset").agg(F.count_distinct("method").alias("n_methods"))
    support = top.groupBy("dataset", "feature").agg(F.count_distinct("method").alias("support"))
    return support.join(present, "dataset")


def robust_set(
    ranking: DataFrame,
    methods: Sequence[str] = C.WRAPPER_METHODS,
    k: int = 10,
    min_size: int = 3,
    min_support: int | None = None,
) -> DataFrame:
    """Features in every top-k list; with fewer than three, the k most frequent.

    `min_support` asks for that many lists instead of all.
    """
    support = method_support(ranking, methods, k)
    needed = F.col("n_methods") if min_support is None else F.lit(min_support)
    everywhere = F.col("support") >= needed
    size = F.sum(everywhere.cast("int")).over(W.partitionBy("dataset"))
    order = W.partitionBy("dataset").orderBy(F.col("support").desc(), "feature")
    marked = support.withColumns({"everywhere": everywhere, "size": size, "place": F.row_number().over(order)})
    keep = F.when(F.col("size") >= min_size, F.col("everywhere")).otherwise(F.col("place") <= k)
    if min_support is not None:
        keep = F.col("everywhere")
    return marked.where(keep).select("dataset", "feature", "support")


def stable_set(stability: DataFrame, min_stability: float = 0.6) -> DataFrame:
    """Features whose selection rate, averaged over methods, is high enough."""
    return (
        stability.groupBy("dataset", "feature")
        .agg(F.avg("stability_rate").alias("stability_rate"))
        .where(F.col("stability_rate") >= min_stability)
    )


def available_sets(ranking: DataFrame) -> DataFrame:
    """Which feature sets a dataset can have, as an ordered array."""

    def has(methods: Sequence[str]):
        return F.max(F.col("method").isin(list(methods)).cast("int")) == 1

    sets = F.array_compact(
        F.array(
            F.lit("full"),
            F.when(has(C.FILTER_METHODS), F.lit("shortlist")),
            F.when(has(C.WRAPPER_METHODS), F.lit("robust_D")),
        )
    )
    return ranking.groupBy("dataset").agg(sets.alias("feature_sets"))


def resolve_set(name: str, ranking: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(dataset, feature) of a named set, limited to features the data has."""
    known = catalogue.select("dataset", "feature").distinct()
    if name == "full":
        return known
    if name == "shortlist":
        chosen = shortlist(ranking)
    elif name == "robust_D":
        chosen = robust_set(ranking)
    else:
        raise ValueError(f"unknown feature set {name!r}")
    return chosen.select("dataset", "feature").join(known, ["dataset", "feature"], "left_semi")


def method_pairs(ranking: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Unordered pairs of methods per dataset, in a given or alphabetical order."""
    position = (
        F.col("method") if order is None else F.array_position(F.array(*[F.lit(m) for m in order]), F.col("method"))
    )
    methods = ranking.select("dataset", "method", position.alias("ord")).distinct()
    a = methods.select("dataset", F.col("method").alias("method_a"), F.col("ord").alias("ord_a"))
    b = methods.select("dataset", F.col("method").alias("method_b"), F.col("ord").alias("ord_b"))
    return a.join(b, "dataset").where(F.col("ord_a") < F.col("ord_b")).select("dataset", "method_a", "method_b")


def method_agreement(
    ranking: DataFrame, ks: Sequence[int] = (5, 10, 15), order: Sequence[str] | None = None
) -> DataFrame:
    """Overlap and Jaccard index of the top-k lists of every pair of methods."""
    place = F.row_number().over(W.partitionBy("dataset", "method").orderBy("rank", "feature"))
    placed = ranking.select("dataset", "method", "feature", place.alias("place"))
    lists = placed.withColumn("top_k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(
        F.col("place") <= F.col("top_k")
    )
    sizes = lists.groupBy("dataset", "method", "top_k").agg(F.count(F.lit(1)).alias("size"))
    pairs = method_pairs(ranking, order).withColumn("top_k", F.explode(F.array(*[F.lit(k) for k in ks])))
    left = lists.select("dataset", "top_k", "feature", F.col("method").alias("method_a"))
    right = lists.select("dataset", "top_k", "feature", F.col("method").alias("method_b"))
    shared = (
        left.join(right, ["dataset", "top_k", "feature"])
        .groupBy("dataset", "method_a", "method_b", "top_k")
        .agg(F.count(F.lit(1)).alias("overlap_count"))
    )
    size_a = sizes.select("dataset", "top_k", F.col("method").alias("method_a"), F.col("size").alias("size_a"))
    size_b = sizes.select("dataset", "top_k", F.col("method").alias("method_b"), F.col("size").alias("size_b"))
    full = (
        pairs.join(shared, ["dataset", "method_a", "method_b", "top_k"], "left")
        .join(size_a, ["dataset", "method_a", "top_k"])
        .join(size_b, ["dataset", "method_b", "top_k"])
        .withColumn("overlap_count", F.coalesce("overlap_count", F.lit(0)))
    )
    union = F.col("size_a") + F.col("size_b") - F.col("overlap_count")
    jaccard = F.coalesce(F.try_divide(F.col("overlap_count").cast("double"), union), F.lit(0.0))
    return full.select("dataset", "method_a", "method_b", "top_k", "overlap_count", jaccard.alias("jaccard"))


def stability_grid(
    scores: DataFrame,
    baseline: DataFrame,
    thresholds: Sequence[float] = (0.0, 0.001, 0.01, 0.05, 0.1),
    top_ns: Sequence[int] = (5, 10, 15, 20),
    tie_digits: int | None = None,
) -> DataFrame:
    """Variance threshold x top-n: the kept features and their share of a baseline list.

    `scores` holds (dataset, feature, score); features at or below a threshold drop out.
    """
    value = F.col("score") if tie_digits is None else F.round("score", tie_digits)
    grid = scores.withColumn("variance_threshold", F.explode(F.array(*[F.lit(float(v)) for v in thresholds])))
    kept = grid.where(F.col("score") > F.col("variance_threshold"))
    order = W.partitionBy("dataset", "variance_threshold").orderBy(value.desc(), F.col("feature"))
    placed = kept.withColumn("place", F.row_number().over(order)).withColumn(
        "top_n", F.explode(F.array(*[F.lit(n) for n in top_ns]))
    )
    chosen = placed.where(F.col("place") <= F.col("top_n"))
    wanted = baseline.select("dataset", "feature").withColumn("hit", F.lit(1))
    size = baseline.groupBy("dataset").agg(F.count(F.lit(1)).alias("baseline_size"))
    lists = (
        chosen.join(wanted, ["dataset", "feature"], "left")
        .groupBy("dataset", "variance_threshold", "top_n")
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "feature"))), lambda s: s["feature"]).alias("features"),
            F.count("hit").alias("hits"),
        )
        .join(size, "dataset")
    )
    return lists.select(
        "dataset",
        "variance_threshold",
        "top_n",
        F.to_json("features").alias("shortlist_json"),
        (F.col("hits") / F.col("baseline_size")).alias("overlap_with_baseline"),
    )


def selection_stability(selected: DataFrame, total_runs: int) -> DataFrame:
    """(dataset, method, feature) -> how often it was selected over the runs.

    `selected` has dataset, method, feature, seed and a 0/1 `selected`.
    """
    counts = selected.groupBy("dataset", "method", "feature").agg(F.sum("selected").alias("selected_count"))
    return counts.withColumns(
        {"total_runs": F.lit(total_runs), "stability_rate": F.col("selected_count") / F.lit(float(total_runs))}
    )


def at_least_percentile(scores: DataFrame, keys: Sequence[str], share: float = 0.7) -> DataFrame:
    """Add `selected`: 1 where a score reaches the given percentile of its group."""
    cut = F.percentile("score", F.lit(share)).over(W.partitionBy(*keys))
    return scores.withColumn("selected", (tidy(F.col("score"), 12) >= tidy(cut, 12)).cast("int"))


def features_like(ranking: DataFrame, text: str) -> DataFrame:
    """Rows whose feature name contains a text, whatever its case."""
    return ranking.where(F.lower("feature").contains(text.lower()))


def decision_of(decisions: DataFrame, dataset: str, model: str) -> DataFrame:
    """The one decision row of a dataset and model; none is an error."""
    row = decisions.where((F.col("dataset") == dataset) & (F.col("model") == model)).limit(1)
    if row.isEmpty():
        raise ValueError(f"no decision for {dataset}/{model}")
    return row
