"""Queries that fit models: no SQL twin, checked by invariants in the tests.

Sizes (trees, depth, folds, repeats, seeds, grids) are those of the lessons they follow.
All models are fitted on all training rows, and all rows are scored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from plumbline import constants as C
from plumbline.functions import tidy
from plumbline.operators import calibration as K
from plumbline.operators import cycle as Y
from plumbline.operators import explain as X
from plumbline.operators import metrics as M
from plumbline.operators import models as H
from plumbline.operators import policy as V
from plumbline.operators import preprocess as P
from plumbline.operators import sampling as S
from plumbline.operators import selection as G
from plumbline.plans.catalogue import query
from plumbline.plans.views import CATEGORICAL, NUMERIC, orders_wide
from plumbline.session import stage

# a depth of None is no limit
FOREST = {"n_trees": 100, "max_depth": None}  # importance, selection and comparison
SEED_FOREST = {"n_trees": 50, "max_depth": None}
TUNED_FOREST = {"n_trees": 350}  # grids, curves and the default model of validation
DEFAULT_FOREST = {**TUNED_FOREST, "max_depth": None}
MONITORED_FOREST = {"n_trees": 320, "max_depth": None}
SPLIT = ("accuracy", "f1", "roc_auc")


def prepared(t, **split):
    """Orders split in three, with a preprocessor fitted on the training part."""
    wide = stage(orders_wide(t), "orders_wide")  # read for the cuts and for the rows
    rows = stage(S.split_three(wide, "row_id", **split), "orders_split")
    return rows, P.fit_preprocessor(rows.where(F.col("split") == "train"), NUMERIC, CATEGORICAL)


def train_vectors(t, folds: int = 0):
    rows, fit = prepared(t)
    train = rows.where(F.col("split") == "train").drop("split")
    if folds:
        train = S.folds(train, "row_id", folds)
    kept = ["row_id", "y", "features", *(["fold"] if folds else [])]
    return stage(fit.vectors(train).select(*kept), "train_vectors"), fit.names


def one_model(name: str, model: str, **params):
    @query(name)
    def _(t):
        rows, fit = prepared(t)
        table = H.compare_models(rows, fit, {model: params}, {"full": None}, "orders", ("train", "validation", "test"))
        return table.select("dataset", "feature_set", "model", "split", *[tidy(F.col(c)).alias(c) for c in SPLIT])


one_model("h01_logistic_regression", "LogisticRegression", class_weight="balanced")
one_model("h02_random_forest", "RandomForest", class_weight="balanced", **DEFAULT_FOREST)
one_model("h03_linear_svm", "LinearSVC")


@query("h05_classifier_scores")
def _(t):
    rows, fit = prepared(t)
    train = rows.where(F.col("split") == "train")
    model = H.fit_classifier(train, NUMERIC, CATEGORICAL, "LogisticRegression", preprocessor=fit)
    return model(rows).select("row_id", "split", "y", "score", "score_source", "predicted")


@query("h08_comparison_matrix")
def _(t):
    rows, fit = prepared(t)
    sets = {"full": None, "shortlist": ["num__n_lines", "num__quantity", "num__discount"], "robust_D": ["num__n_lines"]}
    models = {"LogisticRegression": {}, "RandomForest": FOREST, "LinearSVC": {}}
    return H.compare_models(rows, fit, models, sets, "orders")


@query("h09_grid_search")
def _(t):
    folds, _valid = tuning_rows(t)
    return reduce(DataFrame.unionByName, [H.top_grid_rows(table, 5) for table in both_grids(folds)])


# Results of fits that several queries ask for, by session, label and the rows they come from.
STORE: dict[tuple, DataFrame] = {}


def once(label: str, rows: DataFrame, build: Callable[[], DataFrame]) -> DataFrame:
    """The staged result of `build`, which depends on `rows` (with features and y) only."""
    values = [c for c in rows.columns if c != "features"]
    mark = F.xxhash64(*values, vector_to_array("features")).cast("decimal(38,0)")
    known = (rows.sparkSession.sparkContext.applicationId, label, *rows.agg(F.count(F.lit(1)), F.sum(mark)).first())
    if known not in STORE:
        STORE[known] = stage(build(), label)
    return STORE[known]


def tuning_rows(t):
    """Training vectors in three folds, and validation vectors."""
    rows, fit = prepared(t)
    shared = stage(fit.vectors(rows.where(F.col("split") != "test")).select("row_id", "split", "y", "features"), "tuning_vectors")
    train, valid = (shared.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    return stage(S.folds(train, "row_id", 3), "tuning_folds"), valid


def searched(folds: DataFrame, name: str) -> DataFrame:
    """The grid of one kind of model, fitted once in a session for all queries that need it."""
    fixed = TUNED_FOREST if name == "RandomForest" else {}
    return once(f"grid_{name}", folds, lambda: H.grid_search(folds, name, C.TUNING_GRIDS[name], "orders", "full", fixed=fixed)[0])


def both_grids(folds: DataFrame) -> list[DataFrame]:
    return H.in_parallel([lambda name=name: searched(folds, name) for name in C.TUNING_GRIDS], 2)


def tuned_against_default(t):
    """Validation metrics of each kind's default model and of its best parameter set, both fitted."""
    folds, valid = tuning_rows(t)
    return once("tuned", folds, lambda: tuned_table(folds, valid))


def tuned_table(folds: DataFrame, valid: DataFrame) -> DataFrame:
    train = folds.drop("fold")
    both_grids(folds)
    parts = []
    for name, grid in C.TUNING_GRIDS.items():
        fixed = TUNED_FOREST if name == "RandomForest" else {}
        default = {**DEFAULT_FOREST, "class_weight": "balanced"} if name == "RandomForest" else {"class_weight": "balanced"}
        best = {**fixed, **H.best_params(searched(folds, name), H.param_sets(grid))}
        for variant, params in (("baseline_default", default), ("tuned_best", best)):
            tags = {"dataset": F.lit("orders"), "model": F.lit(name), "feature_set": F.lit("full"), "variant": F.lit(variant)}
            parts.append(H.apply_model(H.fit_model(train, name, **params), valid).select("y", "score", "predicted").withColumns(tags))
    scored = stage(reduce(DataFrame.unionByName, parts), "tuned_scores")
    return M.decision_metrics(scored, ["dataset", "model", "feature_set", "variant"])


@query("h10_fitted_baseline_vs_tuned")
def _(t):
    return tuned_against_default(t).select("dataset", "model", "feature_set", "variant", *[tidy(F.col(c)).alias(c) for c in SPLIT])


@query("h11_fitted_validation_winner")
def _(t):
    return V.validation_winner(tuned_against_default(t)).select("dataset", "model", "variant", *[tidy(F.col(c)).alias(c) for c in SPLIT])


@query("h12_calibrated_variants")
def _(t):
    rows, fit = prepared(t)
    train = S.folds(rows.where(F.col("split") == "train").drop("split"), "row_id", 5)
    holdout = rows.where(F.col("split") == "validation").drop("split")
    train = stage(fit.vectors(train).select("row_id", "y", "features", "fold"), "fold_vectors")
    holdout = stage(fit.vectors(holdout).select("row_id", "y", "features"), "holdout_vectors")

    def variants(name, params):
        scored = H.calibrated_variants(train, holdout, name, **params)
        tags = {"dataset": F.lit("orders"), "model": F.lit(name), "split": F.lit("validation")}
        return scored.withColumns(tags).select(*tags, "variant", "row_id", "y", "score")

    kinds = (("LogisticRegression", {}), ("RandomForest", DEFAULT_FOREST))
    parts = H.in_parallel([lambda kind=kind: variants(*kind) for kind in kinds], 2)
    return K.calibration_audit(parts[0].unionByName(parts[1]))


@query("h14_validation_curve")
def _(t):
    rows, fit = prepared(t)
    vectors = stage(fit.vectors(rows).select("row_id", "split", "y", "features"), "split_vectors")
    train, valid = (vectors.where(F.col("split") == s) for s in ("train", "validation"))
    curves = []
    for name, (param, values) in C.VALIDATION_CURVES.items():
        fixed = TUNED_FOREST if name == "RandomForest" else {}
        curves.append(H.validation_curve(train, valid, name, param, values, **fixed).withColumn("model", F.lit(name)))
    return curves[0].unionByName(curves[1])


def ranked(method: str, scores):
    return G.ranking_table(scores, method, "orders")


@query("f01_recursive_elimination")
def _(t):
    vectors, names = train_vectors(t)
    return ranked("RFE", H.recursive_elimination(vectors, names, keep=10)[0])


@query("f02_forward_selection")
def _(t):
    vectors, names = train_vectors(t, folds=3)
    return ranked("SFS_forward", H.forward_selection(vectors, names, keep=10))


@query("f03_l1_logistic")
def _(t):
    vectors, names = train_vectors(t)
    return ranked("L1_logreg", H.coefficient_scores(vectors, names, C=0.1, l1=True))


@query("f04_forest_importance")
def _(t):
    vectors, names = train_vectors(t)
    return ranked("RF_importance", H.forest_scores(vectors, names, **FOREST))


@query("f05_permutation_of_fitted_model")
def _(t):
    rows, fit = prepared(t)
    train, test = (rows.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    model = H.fit_classifier(train, NUMERIC, CATEGORICAL, "RandomForest", preprocessor=fit, **FOREST)
    ready = fit.imputed(test)
    return X.permutation_importance(ready, model, "row_id", [*NUMERIC, *CATEGORICAL], "roc_auc", repeats=10)


@query("f06_stability_over_seeds")
def _(t):
    vectors, names = train_vectors(t)
    runs = H.selection_runs(vectors, names, "orders", seeds=range(5), keep=10, forest=SEED_FOREST)
    return G.selection_stability(runs, 5)


@query("f07_linear_importance")
def _(t):
    vectors, names = train_vectors(t)
    rows = G.importance_rows(H.coefficient_scores(vectors, names), "orders", "LogisticRegression", "full", "coef_abs")
    return G.rank_importance(rows)


@query("x01_dependence_of_fitted_model")
def _(t):
    rows, fit = prepared(t)
    model = H.fit_classifier(
        rows.where(F.col("split") == "train"), NUMERIC, CATEGORICAL, "LogisticRegression", preprocessor=fit
    )
    curve = X.partial_dependence(fit.imputed(rows.where(F.col("split") == "test")), model, "n_lines")
    return X.dependence_summary(curve)


def cycle(t):
    models = {"LogisticRegression": {}, "RandomForest": MONITORED_FOREST}
    rows = stage(orders_wide(t).drop("yr"), "orders_wide")
    return Y.monitoring_cycle(rows, "row_id", NUMERIC, CATEGORICAL, "orders", size=1000, models=models)


@query("k14_post_retrain_comparison")
def _(t):
    return cycle(t).retraining


@query("k17_full_cycle_decisions")
def _(t):
    return cycle(t).decisions
