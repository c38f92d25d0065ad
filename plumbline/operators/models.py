"""Classifiers as Spark ML estimators, their scores, grids and folds.

Penalties follow the convention "C = inverse strength on the summed loss": Spark
averages the loss, hence regParam = 1 / (C * rows). The feature scaling is the
preprocessor's, so the estimators do not standardise again.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline import constants as C
from plumbline.functions import at_least, clip, sigmoid, sorted_json
from plumbline.operators.forests import FIT_ROWS, WEIGHT, WIDTH, Forest, deepest, fit_forest, fit_rows, without_depth
from plumbline.operators.metrics import decision_metrics, metric_record, to_long
from plumbline.operators.preprocess import Preprocessor, fit_preprocessor
from plumbline.operators.trees import TreeRows, WholeForest, grow_forest, tree_rows
from plumbline.session import stage

FORESTS = ("RandomForest",)


def class_counts(df: DataFrame, y: str = "y") -> dict[int, int]:
    """Rows per class: two numbers."""
    return {r[y]: r["count"] for r in df.groupBy(y).count().collect()}


def balanced_weights(counts: Mapping[int, int]) -> dict[int, float]:
    """n / (classes * rows of the class)."""
    return {label: sum(counts.values()) / (len(counts) * count) for label, count in counts.items()}


def balanced_weight(counts: Mapping[int, int], y: str = "y") -> Column:
    weight = F.lit(None).cast("double")
    for label, own in balanced_weights(counts).items():
        weight = F.when(F.col(y) == label, F.lit(own)).otherwise(weight)
    return weight


def make_estimator(name: str, rows: int, seed: int = C.SEED, **params: Any):
    """A linear estimator by model name: C, and l1=True for LogisticRegression.

    class_weight 'balanced' expects the column `class_weight`.
    """
    common = {"featuresCol": "features", "labelCol": "y"}
    if params.get("class_weight"):
        common["weightCol"] = WEIGHT
    if name == "LogisticRegression":
        return LogisticRegression(
            regParam=1.0 / (params.get("C", 1.0) * rows),
            elasticNetParam=1.0 if params.get("l1") else 0.0,
            standardization=False,
            maxIter=params.get("max_iter", 1000),
            tol=1e-6,
            **common,
        )
    if name == "LinearSVC":
        return LinearSVC(
            regParam=1.0 / (params.get("C", 1.0) * rows),
            standardization=False,
            maxIter=params.get("max_iter", 2500),
            **common,
        )
    raise ValueError(f"unknown model {name!r}")


def fit_model(
    df: DataFrame | TreeRows,
    name: str,
    seed: int = C.SEED,
    counts: Mapping[int, int] | None = None,
    key: str = "row_id",
    max_fit_rows: int | None = None,
    width: int = WIDTH,
    drawn: bool = False,
    **params: Any,
):
    """Fit on a frame with `features` and `y`; class counts are found if not given.

    All rows are used. A RandomForest (n_trees, max_depth with None for no limit,
    min_samples_leaf) on more than `FIT_ROWS` rows is grown by `trees.grow_forest`, whose rows
    may be written already (`tree_rows`). Callers may bound the rows by `max_fit_rows`, drawn by
    the row key unless they are `drawn` already; class weights are those of all rows.
    """
    counts = counts or class_counts(df)
    rows = sum(counts.values())
    balanced = bool(params.get("class_weight"))
    if name not in FORESTS:
        if balanced:
            df = df.withColumn(WEIGHT, balanced_weight(counts))
        return make_estimator(name, rows, seed, **params).fit(df)
    if isinstance(df, TreeRows) or (not drawn and max_fit_rows is None and rows > FIT_ROWS):
        source = df if isinstance(df, TreeRows) else tree_rows(df, key)
        wanted = {k: params[k] for k in ("n_trees", "max_depth", "min_samples_leaf") if k in params}
        return grow_forest(source, weights=balanced_weights(counts) if balanced else None, seed=seed, **wanted)
    fitted = df if drawn else fit_rows(df, counts, max_fit_rows, key, seed)
    if balanced:
        fitted = fitted.withColumn(WEIGHT, balanced_weight(counts))
    wanted = {k: params[k] for k in ("n_trees", "max_depth", "min_samples_leaf", "batch") if k in params}
    return fit_forest(fitted, weighted=balanced, seed=seed, width=width, **wanted)


def with_score(scored: DataFrame) -> DataFrame:
    """Add score in [0, 1] and score_source from whatever the model produced."""
    if "probability" in scored.columns:
        value, source = clip(vector_to_array("probability")[1], 0.0, 1.0), "predict_proba"
    elif "rawPrediction" in scored.columns:
        value, source = sigmoid(vector_to_array("rawPrediction")[1]), "decision_function_sigmoid"
    else:
        value, source = clip(F.col("prediction").cast("double"), 0.0, 1.0), "predict"
    return scored.withColumns({"score": value, "score_source": F.lit(source)}).drop("probability", "rawPrediction")


def apply_model(model, df: DataFrame) -> DataFrame:
    """Rows with score, score_source and the model's own 0/1 decision."""
    if isinstance(model, (Forest, WholeForest)):
        return model.scored(df).withColumn("score_source", F.lit("predict_proba"))
    out = with_score(model.transform(df))
    return out.withColumn("predicted", F.col("prediction").cast("int")).drop("prediction")


class FittedClassifier:
    """Preprocessor plus model: scores raw feature rows."""

    def __init__(self, preprocessor: Preprocessor, model, features: Sequence[str] | None):
        self.preprocessor, self.model, self.features = preprocessor, model, features

    def vectors(self, df: DataFrame) -> DataFrame:
        return self.preprocessor.vectors(df, self.features)

    def __call__(self, df: DataFrame) -> DataFrame:
        """Input columns as they were, plus score, score_source and predicted."""
        packed = df.select(F.struct("*").alias("__row"), "*")
        out = apply_model(self.model, self.vectors(packed))
        return out.select("__row.*", "score", "score_source", "predicted")

    @property
    def names(self) -> list[str]:
        return list(self.features) if self.features is not None else self.preprocessor.names


def fit_classifier(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    model: str,
    features: Sequence[str] | None = None,
    preprocessor: Preprocessor | None = None,
    seed: int = C.SEED,
    **params: Any,
) -> FittedClassifier:
    fitted = preprocessor or fit_preprocessor(train, numeric, categorical)
    rows = fitted.vectors(train, features)
    key = params.get("key", "row_id")
    vectors = rows.select("features", "y", *[c for c in [key] if c in rows.columns]).persist()
    try:
        return FittedClassifier(fitted, fit_model(vectors, model, seed, **params), features)
    finally:
        vectors.unpersist()


def monitoring_classifier(train: DataFrame, numeric, categorical, model: str, seed: int = C.SEED, **params):
    """The two monitored models: balanced logistic regression, balanced forest."""
    return fit_classifier(train, numeric, categorical, model, seed=seed, **{"class_weight": "balanced", **params})


def in_parallel(jobs: Sequence[Callable[[], Any]], width: int = 4) -> list[Any]:
    """Run independent fits side by side; Spark interleaves their stages."""
    if len(jobs) < 2 or width < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(width) as pool:
        return list(pool.map(lambda job: job(), jobs))


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more)
    return united


def _scored_once(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of scored rows, cached: metrics read them twice, models score once."""
    return stage(_united(parts), "model_scores")


def compare_models(
    df: DataFrame,
    preprocessor: Preprocessor,
    models: Mapping[str, Mapping[str, Any]],
    feature_sets: Mapping[str, Sequence[str] | None],
    dataset: str,
    splits: Sequence[str] = ("train", "validation"),
    width: int = 4,
    key: str = "row_id",
) -> DataFrame:
    """Fit every model on every feature set; metrics per split in one job.

    `df` has `split` and the raw features. `models` maps a label to parameters,
    with the model name under "model" unless the label is the name.
    """
    cells = []
    counts = class_counts(df.where(F.col("split") == splits[0]))
    for set_name, features in feature_sets.items():
        vectors = preprocessor.vectors(df.where(F.col("split").isin(list(splits))), features)
        # Fits of one feature set share the vectors; the cache spills to disk and
        # is rebuilt from lineage if an executor goes.
        vectors = stage(vectors.select("split", "y", "features", *[c for c in [key] if c in vectors.columns]), "curve_vectors")
        for label, params in models.items():
            cells.append((set_name, label, dict(params), vectors))

    def job(cell):
        set_name, label, params, vectors = cell
        name = params.pop("model", label)
        model = fit_model(vectors.where(F.col("split") == splits[0]), name, counts=counts, key=key, **params)
        tags = {"dataset": F.lit(dataset), "feature_set": F.lit(set_name), "model": F.lit(label)}
        return apply_model(model, vectors).select("split", "y", "score", "predicted").withColumns(tags)

    parts = in_parallel([lambda c=c: job(c) for c in cells], width)
    keys = ["dataset", "feature_set", "model", "split"]
    return decision_metrics(_scored_once(parts), keys)


def cross_validate(
    df: DataFrame, name: str, fold: str = "fold", width: int = 4, label: str = "run", **params: Any
) -> DataFrame:
    """Out-of-fold rows (fold, y, score, predicted) of one model.

    `df` has features, y and a fold column. Each fold is scored by a model that
    never saw it, which is also what calibration needs.
    """
    sizes = fold_counts(df, fold)
    outside = _outside(df, name, sizes, fold, params)

    def job(k):
        return apply_model(outside(k, {"batch": None, **params}), df.where(F.col(fold) == k))

    parts = in_parallel([lambda k=k: job(k) for k in sorted(sizes)], width)
    return _united(parts).withColumn(label, F.lit(name))


def _outside(df: DataFrame, name: str, sizes: Mapping[int, Mapping[int, int]], fold: str, params: Mapping[str, Any]) -> Callable:
    """A function that fits a model to all rows outside a fold. A forest's rows are written once for all folds."""
    key, most, drawn = params.get("key", "row_id"), params.get("max_fit_rows"), name in FORESTS
    if drawn and most is None and sum(counts_without(sizes, None).values()) > FIT_ROWS:
        rows = tree_rows(df, key, fold)
        return lambda k, own: fit_model(rows.without(k), name, counts=counts_without(sizes, k), **own)
    source = fit_rows(df, counts_without(sizes, None), most, key, keep=[fold]) if drawn else df
    return lambda k, own: fit_model(source.where(F.col(fold) != k), name, counts=counts_without(sizes, k), drawn=drawn, **own)


def fold_counts(df: DataFrame, fold: str = "fold") -> dict[int, dict[int, int]]:
    """Rows per fold and class."""
    sizes: dict[int, dict[int, int]] = {}
    for r in df.groupBy(fold, "y").count().collect():
        sizes.setdefault(r[fold], {})[r["y"]] = r["count"]
    return sizes


def counts_without(sizes: Mapping[int, Mapping[int, int]], held: int | None) -> dict[int, int]:
    """Rows per class outside a fold (None: of all folds)."""
    total: dict[int, int] = {}
    for k, classes in sizes.items():
        if k != held:
            for label, n in classes.items():
                total[label] = total.get(label, 0) + n
    return total


def cv_stability(scored: DataFrame, keys: Sequence[str], fold: str = "fold") -> DataFrame:
    """Metrics per fold of out-of-fold rows."""
    return decision_metrics(scored, [*keys, fold])


def cv_summary(per_fold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and population deviation over folds."""
    cells = []
    for metric in ("accuracy", "f1", "roc_auc"):
        cells += [F.avg(metric).alias(f"mean_cv_{metric}"), F.stddev_pop(metric).alias(f"std_cv_{metric}")]
    return per_fold.groupBy(*keys).agg(*cells)


def param_sets(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def params_column(params: Mapping[str, Any]) -> Column:
    """A parameter set as JSON with sorted keys."""
    cells = [F.lit(str(part)) for item in params.items() for part in item]
    return sorted_json(F.create_map(*cells))


def grid_search(
    df: DataFrame,
    name: str,
    grid: Mapping[str, Sequence[Any]],
    dataset: str,
    feature_set: str,
    fold: str = "fold",
    width: int = WIDTH,
    fixed: Mapping[str, Any] | None = None,
) -> tuple[DataFrame, list[dict[str, Any]]]:
    """Cross-validated metrics of every parameter set, as one table.

    Returns the summary (param_id, params_json, mean and std per metric) and the
    list of parameter sets that param_id points to. Parameter sets of a forest that
    differ in depth only share one fit per fold, grown to the greatest depth.
    """
    choices = param_sets(grid)
    sizes = fold_counts(df, fold)
    outside = _outside(df, name, sizes, fold, fixed or {})
    keep = ["y", fold]

    def fitted(params, k):
        return outside(k, {"batch": None, **params}), df.where(F.col(fold) == k)

    def tags(i):
        return {"param_id": F.lit(i), "params_json": params_column(choices[i])}

    def one(i, k):
        model, held = fitted({**(fixed or {}), **choices[i]}, k)
        return apply_model(model, held).select(*keep, "score", "predicted").withColumns(tags(i))

    def family(ids, k):
        depths = [choices[i]["max_depth"] for i in ids]
        model, held = fitted({**(fixed or {}), **choices[ids[0]], "max_depth": deepest(depths)}, k)
        scored = model.depths(held, depths, keep)
        return _united([scored.where(F.col("depth_no") == n).drop("depth_no").withColumns(tags(i)) for n, i in enumerate(ids)])

    if name in FORESTS and "max_depth" in grid:
        alike: dict[str, list[int]] = {}
        for i, choice in enumerate(choices):
            alike.setdefault(str(without_depth(choice)), []).append(i)
        jobs = [lambda ids=ids, k=k: stage(family(ids, k), "depths") for ids in alike.values() for k in sorted(sizes)]
    else:
        jobs = [lambda i=i, k=k: one(i, k) for i in range(len(choices)) for k in sorted(sizes)]
    tagged = _scored_once(in_parallel(jobs, width)).withColumns(
        {"dataset": F.lit(dataset), "feature_set": F.lit(feature_set), "model": F.lit(name)}
    )
    keys = ["dataset", "feature_set", "model", "param_id", "params_json"]
    return cv_summary(cv_stability(tagged, keys, fold), keys), choices


def top_grid_rows(summary: DataFrame, top_n: int = 5) -> DataFrame:
    """Best parameter sets per group by mean F1."""
    order = W.partitionBy("dataset", "feature_set", "model").orderBy(F.col("mean_cv_f1").desc(), "param_id")
    return summary.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def best_params(summary: DataFrame, choices: Sequence[Mapping[str, Any]]) -> dict[str, Any]:
    return dict(choices[top_grid_rows(summary, 1).first()["param_id"]])


def validation_curve(
    train: DataFrame, valid: DataFrame, name: str, param: str, values: Sequence[Any], **fixed: Any
) -> DataFrame:
    """Train and validation metrics along one parameter, as long rows.

    All depths of a forest come from one fit, grown to the greatest of them.
    """
    parts = []
    counts = class_counts(train)
    splits = (("train", train), ("validation", valid))
    tags = lambda value, split: {"param": F.lit(param), "value": F.lit(str(value)), "split": F.lit(split)}
    if name in FORESTS and param == "max_depth":
        model = fit_model(train, name, counts=counts, **{**fixed, param: deepest(values)})
        for split, rows in splits:
            scored = stage(model.depths(rows, values, ["y"]), "depths")
            parts += [scored.where(F.col("depth_no") == i).drop("depth_no").withColumns(tags(v, split)) for i, v in enumerate(values)]
    else:
        for value in values:
            model = fit_model(train, name, counts=counts, **{**fixed, param: value})
            for split, rows in splits:
                parts.append(apply_model(model, rows).select("y", "score", "predicted").withColumns(tags(value, split)))
    wide = decision_metrics(_scored_once(parts), ["param", "value", "split"])
    renamed = wide.withColumnRenamed("value", "param_value")
    return to_long(renamed, ["param", "param_value", "split"], ["accuracy", "f1", "roc_auc"])


# --- calibrated variants ----------------------------------------------------------


def calibrated_variants(
    train: DataFrame, holdout: DataFrame, name: str, folds: int = 5, width: int = WIDTH, **params: Any
) -> DataFrame:
    """Holdout rows scored by three variants of one model.

    The calibrators learn from out-of-fold scores of the training rows (columns
    features, y, fold), never from the holdout. Equal scores are counted before the isotonic
    fit, which pools adjacent violators inside score ranges in the tasks; only the blocks
    left there reach the driver. Blocks have rising shares of label 1, so of n rows there are
    fewer than n ** (2/3).
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression

    whole = lambda: fit_model(train, name, **{"batch": None, **params})
    inside = lambda: stage(cross_validate(train, name, "fold", width, **params).select("y", "score"), "out_of_fold")
    inner, model = in_parallel([inside, whole], 2)
    pack = VectorAssembler(inputCols=["score"], outputCol="features")
    platt = LogisticRegression(featuresCol="features", labelCol="y", regParam=0.0, maxIter=1000)
    sigmoid_map = platt.fit(pack.transform(inner))
    counted = inner.groupBy("score").agg(F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("n"))
    isotonic = IsotonicRegression(featuresCol="score", labelCol="y", weightCol="n", isotonic=True).fit(counted)
    plain = apply_model(model, holdout).drop("features", "predicted")
    slope, shift = float(sigmoid_map.coefficients[0]), float(sigmoid_map.intercept)
    as_sigmoid = plain.withColumn("score", sigmoid(F.lit(slope) * F.col("score") + F.lit(shift)))
    as_isotonic = isotonic.transform(plain).withColumn("score", clip(F.col("prediction"), 0.0, 1.0)).drop("prediction")
    return (
        plain.withColumn("variant", F.lit("uncalibrated"))
        .unionByName(as_sigmoid.withColumn("variant", F.lit("calibrated_sigmoid")))
        .unionByName(as_isotonic.withColumn("variant", F.lit("calibrated_isotonic")))
    )


# --- model-based feature scores -----------------------------------------------------


def _vector_rows(df: DataFrame | TreeRows, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def coefficient_scores(df: DataFrame, names: Sequence[str], **params: Any) -> DataFrame:
    """Absolute coefficients of a logistic regression (l1=True, C=0.1 for the sparse one)."""
    model = fit_model(df, "LogisticRegression", **params)
    return _vector_rows(df, names, [abs(v) for v in model.coefficients.toArray()])


def forest_scores(df: DataFrame | TreeRows, names: Sequence[str], **params: Any) -> DataFrame:
    model = fit_model(df, "RandomForest", **params)
    return _vector_rows(df, names, model.importances)


def sliced(df: DataFrame, kept: Sequence[int]) -> DataFrame:
    from pyspark.ml.feature import VectorSlicer

    slicer = VectorSlicer(inputCol="features", outputCol="__kept", indices=list(kept))
    return slicer.transform(df).drop("features").withColumnRenamed("__kept", "features")


def recursive_elimination(
    df: DataFrame, names: Sequence[str], keep: int = 10, **params: Any
) -> tuple[DataFrame, list[str]]:
    """Drop the weakest |coefficient| one at a time until `keep` remain.

    Scores are 1 / (rank + 1e-6): rank 1 for kept features, then 2, 3, ... in
    reverse order of elimination. Each fit is distributed; only names move here.
    """
    alive = list(range(len(names)))
    gone: list[int] = []
    counts = class_counts(df)
    while len(alive) > keep:
        part = sliced(df, alive)
        sizes = [abs(v) for v in fit_model(part, "LogisticRegression", counts=counts, **params).coefficients.toArray()]
        weakest = min(range(len(alive)), key=lambda i: (sizes[i], -alive[i]))
        gone.append(alive.pop(weakest))
    rank = {i: 1 for i in alive}
    rank.update({i: 2 + k for k, i in enumerate(reversed(gone))})
    scores = [1.0 / (rank[i] + 1e-6) for i in range(len(names))]
    return _vector_rows(df, names, scores), [names[i] for i in alive]


def forward_selection(
    df: DataFrame, names: Sequence[str], keep: int = 10, fold: str = "fold", width: int = 4, **params: Any
) -> DataFrame:
    """Add the feature with the best cross-validated accuracy, `keep` times.

    The regressions of a round, one per candidate and fold, are fitted together: an iteration
    of all of them is one pass over the rows (`joint_logistic`). L1 penalties have no such
    steps, so those models are fitted one by one.
    """
    sizes = fold_counts(df, fold)
    folds = sorted(sizes)
    chosen: list[int] = []
    start: dict[int, np.ndarray] = {}
    while len(chosen) < min(keep, len(names)):
        candidates = [i for i in range(len(names)) if i not in chosen]
        cells = list(itertools.product(candidates, folds))
        if params.get("l1"):
            right = _held_rates(df, [([*chosen, i], k) for i, k in cells], sizes, fold, width, params)
        else:
            # a candidate's model starts from the one without it
            models = [([*chosen, i], k, np.append(start[k], 0.0) if start else np.zeros(2)) for i, k in cells]
            weights = joint_logistic(df, models, sizes, fold, **{k: v for k, v in params.items() if k != "l1"})
            right = _rates(df, [(m[0], m[1], w) for m, w in zip(models, weights)], sizes, fold)
        rates = {i: round(float(np.mean([r for (c, _), r in zip(cells, right) if c == i])), 12) for i in candidates}
        best = max(candidates, key=lambda i: (rates[i], -i))
        if not params.get("l1"):
            start = {k: w for (i, k), w in zip(cells, weights) if i == best}
        chosen.append(best)
    return _vector_rows(df, names, [1.0 if i in chosen else 0.0 for i in range(len(names))])


def _held_rates(df: DataFrame, models: Sequence, sizes: Mapping, fold: str, width: int, params: Mapping[str, Any]) -> list[float]:
    """Accuracy on the held fold of (columns, held fold) models, fitted one by one."""

    def job(no):
        columns, k = models[no]
        part = sliced(df, columns)
        model = fit_model(part.where(F.col(fold) != k), "LogisticRegression", counts=counts_without(sizes, k), **params)
        right = (F.col("predicted") == F.col("y")).cast("double")
        return apply_model(model, part.where(F.col(fold) == k)).select(F.lit(no).alias("no"), right.alias("right"))

    parts = in_parallel([lambda no=no: job(no) for no in range(len(models))], width)
    found = {r["no"]: r["rate"] for r in _united(parts).groupBy("no").agg(F.avg("right").alias("rate")).collect()}
    return [found[no] for no in range(len(models))]


def _summed(df: DataFrame, fold: str, size: int, sums: Callable) -> np.ndarray:
    """`sums(x, y, fold, total)` adds a batch of rows to `size` numbers; their totals over all rows."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
                sums(x, np.asarray(batch.column(1)), np.asarray(batch.column(0)), total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["cell", "value"])

    rows = df.select(F.col(fold).cast("long"), F.col("y").cast("double"), vector_to_array("features").alias("x"))
    out = np.zeros(size)
    for r in rows.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r["cell"]] = r["value"]
    return out


def joint_logistic(
    df: DataFrame,
    models: Sequence[tuple[Sequence[int], int, np.ndarray]],
    sizes: Mapping[int, Mapping[int, int]],
    fold: str = "fold",
    C: float = 1.0,
    class_weight: str | None = None,
    max_iter: int = 100,
    tol: float = 1e-8,
) -> list[np.ndarray]:
    """Weights (intercept first) of many small logistic regressions by Newton steps, one pass per step.

    A model is (columns of `features`, fold left out, first weights). It minimises the summed
    loss plus |weights|^2 / (2 C), as `make_estimator` does. Tasks sum loss, gradient and
    curvature of all models; a step that raises a model's loss is halved.
    """
    width = max(len(m[0]) for m in models) + 1
    block = 1 + width + width * width
    labels = {}
    for k in sizes:
        counts = counts_without(sizes, k)
        labels[k] = {c: sum(counts.values()) / (len(counts) * n) if class_weight else 1.0 for c, n in counts.items()}
    now = [np.asarray(m[2], float) for m in models]
    kept = [(None, np.inf)] * len(models)  # weights and loss of the last step taken
    steps = [np.zeros(len(w)) for w in now]
    open_ = list(range(len(models)))
    for _ in range(max_iter):
        work: dict[int, list[tuple[int, list[int], np.ndarray]]] = {}
        for place, no in enumerate(open_):
            work.setdefault(models[no][1], []).append((place, list(models[no][0]), now[no]))

        def sums(x, y, held, total, work=work):
            for k, jobs in work.items():
                rows = held != k
                own, target = np.column_stack([np.ones(rows.sum()), x[rows]]), y[rows]
                weight = np.where(target == 1, labels[k].get(1, 1.0), labels[k].get(0, 1.0))
                for place, columns, w in jobs:
                    part = own[:, [0, *[c + 1 for c in columns]]]
                    margin = part @ w
                    p = 0.5 + 0.5 * np.tanh(0.5 * margin)
                    n = len(w)
                    cells = total[place * block : (place + 1) * block]
                    cells[0] += (weight * (np.logaddexp(0.0, margin) - target * margin)).sum()
                    cells[1 : 1 + n] += part.T @ (weight * (p - target))
                    cells[1 + width : 1 + width + n * n] += (part.T @ (part * (weight * p * (1.0 - p))[:, None])).ravel()

        total = _summed(df, fold, block * len(open_), sums).reshape(len(open_), block)
        still = []
        for cells, no in zip(total, open_):
            w, n = now[no], len(now[no])
            penalty = np.r_[0.0, np.full(n - 1, 1.0 / C)]
            loss = cells[0] + 0.5 * (penalty * w * w).sum()
            if loss > kept[no][1] * (1 + 1e-12) + 1e-12:
                steps[no] = steps[no] / 2
                now[no] = kept[no][0] + steps[no]
            else:
                kept[no] = (w, loss)
                curve = cells[1 + width : 1 + width + n * n].reshape(n, n) + np.diag(penalty)
                steps[no] = -np.linalg.lstsq(curve, cells[1 : 1 + n] + penalty * w, rcond=None)[0]
                now[no] = w + steps[no]
            if np.abs(steps[no]).max() > tol * max(1.0, np.abs(now[no]).max()):
                still.append(no)
        open_ = still
        if not open_:
            break
    return now


def _rates(df: DataFrame, models: Sequence[tuple[Sequence[int], int, np.ndarray]], sizes: Mapping, fold: str) -> list[float]:
    """Accuracy of each model on the fold it left out, from one pass."""

    def sums(x, y, held, total):
        for no, (columns, k, w) in enumerate(models):
            rows = held == k
            margin = x[rows][:, columns] @ w[1:] + w[0]
            total[no] += ((margin > 0) == (y[rows] == 1)).sum()

    right = _summed(df, fold, len(models), sums)
    return [r / sum(sizes[k].values()) for r, (_, k, _w) in zip(right, models)]


def selection_runs(
    df: DataFrame,
    names: Sequence[str],
    dataset: str,
    seeds: Sequence[int] = (0, 1, 2, 3, 4),
    keep: int = 10,
    share: float = 0.7,
    methods: Sequence[str] = ("RFE", "L1_logreg", "RF_importance"),
    forest: Mapping[str, Any] | None = None,
) -> DataFrame:
    """(dataset, method, feature, seed, selected) over repeated fits.

    The linear fits are deterministic, so one fit serves all seeds. The forests of all
    seeds are grown on the same written rows.
    """
    from plumbline.operators.selection import at_least_percentile

    parts = []
    for method in methods:
        if method == "RFE":
            scores, kept = recursive_elimination(df, names, keep)
            once = scores.withColumn("selected", F.col("feature").isin(kept).cast("int"))
        elif method == "L1_logreg":
            scores = coefficient_scores(df, names, C=0.1, l1=True)
            once = scores.withColumn("selected", (F.col("score") > 1e-4).cast("int"))
        else:
            once = None
            counts = class_counts(df)
            few = sum(counts.values()) <= FIT_ROWS
            rows = fit_rows(df, counts) if few else tree_rows(df)
            sizes = {"n_trees": 50, "counts": counts, "drawn": few, "width": 2, **(forest or {})}
            grown = in_parallel([lambda seed=seed: forest_scores(rows, names, seed=seed, **sizes) for seed in seeds], WIDTH)
        for i, seed in enumerate(seeds):
            if once is None:
                rows = at_least_percentile(grown[i].withColumn("g", F.lit(0)), ["g"], share).drop("g")
            else:
                rows = once
            tags = {"dataset": F.lit(dataset), "method": F.lit(method), "seed": F.lit(seed)}
            parts.append(rows.select("feature", "selected").withColumns(tags))
    return _united(parts).select("dataset", "method", "feature", "seed", "selected")


def evaluate(classifier, df: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Full metric record of a scorer on labelled rows."""
    return metric_record(classifier(df), keys, threshold)


def decide(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("predicted", at_least(F.col("score"), threshold))
