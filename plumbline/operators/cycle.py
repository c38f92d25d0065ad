"""The whole monitoring cycle: reference models, windows, audits, retraining."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from plumbline import constants as C
from plumbline.operators.drift import drift_audit
from plumbline.operators.metrics import metric_record
from plumbline.operators.models import FittedClassifier, in_parallel, monitoring_classifier
from plumbline.operators.retrain import quality_audit, reference_metrics, retraining_decisions
from plumbline.operators.sampling import monitoring_windows, split_two
from plumbline.session import stage

DEFAULT_MODELS: Mapping[str, Mapping[str, Any]] = {
    "LogisticRegression": {},
    "RandomForest": {"n_trees": 320},
}


class MonitoringCycle:
    """The four audit tables over shared, written windows; each is worked out when asked for."""

    def __init__(self, **tables: Callable[[MonitoringCycle], DataFrame]):
        self._tables = tables

    def _once(self, name: str) -> DataFrame:
        made = self.__dict__.setdefault("_made", {})
        if name not in made:
            made[name] = self._tables[name](self)
        return made[name]

    drift = property(lambda self: self._once("drift"))
    quality = property(lambda self: self._once("quality"))
    decisions = property(lambda self: self._once("decisions"))
    retraining = property(lambda self: self._once("retraining"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more)
    return united


def reference_models(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    models: Mapping[str, Mapping[str, Any]] = DEFAULT_MODELS,
    seed: int = C.SEED,
) -> tuple[DataFrame, dict[str, FittedClassifier]]:
    """Reference rows (0.35 of the table) and models trained on the rest."""
    parts = split_two(df, key, test_share=C.REFERENCE_SHARE, seed=seed, names=("train", "reference"))
    parts = stage(parts.withColumns({c: F.col(c).cast("double") for c in numeric}), "monitored")
    train = parts.where(F.col("split") == "train").drop("split")
    reference = parts.where(F.col("split") == "reference").drop("split")
    names = list(models)
    fitted = in_parallel(
        [lambda n=n: monitoring_classifier(train, numeric, categorical, n, seed, key=key, **models[n]) for n in names], 2
    )
    return reference, dict(zip(names, fitted))


def score_with_all(df: DataFrame, models: Mapping[str, FittedClassifier]) -> DataFrame:
    """Every row scored by every model; narrow and cached, as metrics read it twice."""
    keep = [c for c in ("window_id", "scenario", "y") if c in df.columns]
    parts = [m(df).select(*keep, "score").withColumn("model_variant", F.lit(n)) for n, m in models.items()]
    return stage(_union(parts), "scored_windows")


def post_retrain_comparison(
    windows: DataFrame,
    models: Mapping[str, FittedClassifier],
    numeric: Sequence[str],
    categorical: Sequence[str],
    dataset: str,
    model_variant: str = "RandomForest",
    params: Mapping[str, Any] | None = None,
    key: str = "row_key",
    seed: int = C.SEED,
) -> DataFrame:
    """Metrics before and after refitting on each window, on the same test slice.

    All windows are split in one pass; each refit sees the rows of one window, and
    the scores of both phases of all windows are compared in one job.
    """
    if model_variant not in models:
        raise ValueError(f"unknown model {model_variant!r}; known: {sorted(models)}")
    parts = split_two(windows, key, strata=("window_id", "y"), test_share=C.RETRAIN_TEST_SHARE, seed=seed)
    parts = stage(parts, "window_split")
    test, train = parts.where(F.col("split") == "test"), parts.where(F.col("split") == "train")
    ids = [r[0] for r in windows.select("window_id").distinct().orderBy("window_id").collect()]

    def refit(i):
        rows = train.where(F.col("window_id") == i)
        model = monitoring_classifier(rows, numeric, categorical, model_variant, seed, key=key, width=2, **(params or {}))
        return model(test.where(F.col("window_id") == i)).select("scenario", "y", "score")

    after = _union(in_parallel([lambda i=i: refit(i) for i in ids], 4))
    before = models[model_variant](test).select("scenario", "y", "score")
    both = before.withColumn("phase", F.lit("before_retrain")).unionByName(
        after.withColumn("phase", F.lit("after_retrain"))
    )
    both = stage(both.withColumn("dataset", F.lit(dataset)), "before_and_after")
    record = metric_record(both, ["dataset", "scenario", "phase"])
    return record.select(*C.RETRAIN_COLUMNS)


def monitoring_cycle(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    dataset: str,
    size: int = 240,
    seed: int = C.SEED,
    models: Mapping[str, Mapping[str, Any]] = DEFAULT_MODELS,
    retrain_with: str = "RandomForest",
) -> MonitoringCycle:
    """From a labelled feature table (column y) to the four audit tables."""
    reference, fitted = reference_models(df, key, numeric, categorical, models, seed)
    # The windows feed every table, so they are drawn once and written.
    windows = stage(monitoring_windows(reference, key, numeric, categorical, size, seed), "windows")
    tag = {"dataset": F.lit(dataset)}

    def quality(_):
        baseline = reference_metrics(score_with_all(reference, fitted).withColumns(tag))
        return quality_audit(score_with_all(windows, fitted).withColumns(tag), baseline)

    return MonitoringCycle(
        drift=lambda _: drift_audit(reference, windows, numeric, categorical, dataset),
        quality=quality,
        decisions=lambda own: retraining_decisions(own.drift, own.quality),
        retraining=lambda _: post_retrain_comparison(
            windows, fitted, numeric, categorical, dataset, retrain_with, models.get(retrain_with), seed=seed
        ),
    )
