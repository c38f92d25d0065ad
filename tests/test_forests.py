"""Bounded forests, all depths of one fit, and the fitted queries run to their end."""

import itertools

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.operators import forests as D
from plumbline.operators import models as H
from plumbline.plans import QUERIES, fitted, load_all
from plumbline.session import stage

load_all()


@pytest.fixture(scope="module")
def vectors(spark):
    u = lambda seed: F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), 1, 6), 16, 10).cast("double") / 16777216.0
    df = spark.range(600).select(F.col("id").alias("row_id"), u("a").alias("a"), u("b").alias("b"), (u("c") > 0.5).cast("double").alias("flag"), u("d").alias("d"))
    df = df.withColumn("y", (F.col("d") < 0.2 + 0.6 * F.col("a") * F.col("flag")).cast("int")).withColumn("fold", (F.col("row_id") % 3).cast("int"))
    return stage(VectorAssembler(inputCols=["a", "b", "flag"], outputCol="features").transform(df).drop("a", "b", "flag", "d"), "vectors")


def test_fitted_rows_are_bounded_and_stratified(spark, vectors):
    counts = H.class_counts(vectors)
    assert D.fit_rows(vectors, counts, 600).count() == 600  # at the bound: whole
    some = D.fit_rows(vectors, counts, 100, keep=["row_id"])
    got = {r["y"]: r["count"] for r in some.groupBy("y").count().collect()}
    assert got == {y: n * 100 // 600 for y, n in counts.items()}
    again = D.fit_rows(vectors.repartition(7), counts, 100, keep=["row_id"])
    assert [r.row_id for r in some.collect()] == [r.row_id for r in again.collect()]
    rare = vectors.where("y = 0").unionByName(vectors.where("y = 1").limit(1))
    assert D.fit_rows(rare, H.class_counts(rare), 20).where("y = 1").count() == 1
    assert D.fit_rows(vectors.drop("row_id"), counts, 100).count() == some.count()


def test_all_rows_are_scored_by_a_bounded_forest(vectors):
    model = H.fit_model(vectors, "RandomForest", n_trees=6, batch=2, max_fit_rows=60)
    assert len(model.parts) == 3 and sum(model.importances) == pytest.approx(1)
    out = H.apply_model(model, vectors).collect()
    assert len(out) == 600 and all(0 <= r.score <= 1 and r.predicted == (r.score > 0.5) for r in out)


def test_depths_of_one_fit_equal_separate_fits(vectors):
    rows = D.fit_rows(vectors, H.class_counts(vectors))
    whole = D.fit_forest(rows, n_trees=8, batch=None)
    limits = [1, 4, None]
    found = D.DepthForest(whole, vectors.sparkSession).scored(vectors, limits, ["row_id"]).toPandas()
    for i, depth in enumerate(limits):
        alone = D.fit_forest(rows, n_trees=8, max_depth=depth, batch=None)
        want = alone.scored(vectors).select("row_id", "score", "predicted").toPandas().sort_values("row_id")
        got = found[found["depth_no"] == i].sort_values("row_id")
        assert np.allclose(got["score"], want["score"]) and (got["predicted"].to_numpy() == want["predicted"].to_numpy()).all(), depth


def test_grid_equals_a_plain_loop(vectors):
    grid = {"max_depth": (2, 5), "min_samples_leaf": (1, 5), "class_weight": (None, "balanced")}
    table, choices = H.grid_search(vectors, "RandomForest", grid, "t", "full", fixed={"n_trees": 5})
    got = {r.param_id: (r.mean_cv_accuracy, r.mean_cv_f1, r.mean_cv_roc_auc) for r in table.collect()}
    assert len(choices) == len(got) == 8
    for i, choice in enumerate(choices):
        accuracy = []
        for k in range(3):
            train = D.fit_rows(vectors, H.class_counts(vectors), keep=["fold"]).where(F.col("fold") != k)
            if choice["class_weight"]:
                train = train.withColumn("class_weight", H.balanced_weight(H.class_counts(train)))
            forest = RandomForestClassifier(
                labelCol="y", numTrees=5, maxDepth=choice["max_depth"], minInstancesPerNode=choice["min_samples_leaf"],
                featureSubsetStrategy="sqrt", seed=C.SEED, cacheNodeIds=True, maxMemoryInMB=1024,
            )
            forest = forest.setWeightCol("class_weight") if choice["class_weight"] else forest
            held = forest.fit(train).transform(vectors.where(F.col("fold") == k))
            accuracy.append(held.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0])
        assert got[i][0] == pytest.approx(np.mean(accuracy)), choice


def test_counted_isotonic_fit_equals_the_plain_one(spark):
    from pyspark.ml.regression import IsotonicRegression

    rows = spark.range(2000).select((F.col("id") * 37 % 101 / 101).alias("score"), ((F.col("id") * 37 % 101) * (F.col("id") % 7) > 250).cast("double").alias("y"))
    plain = IsotonicRegression(featuresCol="score", labelCol="y").fit(rows)
    counted = rows.groupBy("score").agg(F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("n"))
    weighted = IsotonicRegression(featuresCol="score", labelCol="y", weightCol="n").fit(counted)
    a, b = (sorted((r.score, round(r.prediction, 9)) for r in m.transform(rows).select("score", "prediction").distinct().collect()) for m in (plain, weighted))
    assert a == b


SMALL = {"n_trees": 4, "max_depth": None}
ENDS = {
    "h02_random_forest": 3,
    "h09_grid_search": 10,
    "h10_fitted_baseline_vs_tuned": 4,
    "h11_fitted_validation_winner": 1,
    "h12_calibrated_variants": 6,
    "h14_validation_curve": 60,
    "k14_post_retrain_comparison": 8,
    "k17_full_cycle_decisions": 4,
}


@pytest.fixture(scope="module")
def results(spark):
    """Whole queries, grids and folds included; only the forests have few trees."""
    patch = pytest.MonkeyPatch()
    for name in ("FOREST", "SEED_FOREST", "DEFAULT_FOREST", "MONITORED_FOREST"):
        patch.setattr(fitted, name, SMALL)
    patch.setattr(fitted, "TUNED_FOREST", {"n_trees": 4})
    patch.setattr(fitted, "STORE", {})
    done = {}

    def run(name):
        if name not in done:
            done[name] = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        return done[name]

    yield run
    patch.undo()


@pytest.mark.parametrize("name", ENDS)
def test_fitted_queries_end(results, name):
    assert len(results(name)) == ENDS[name]


def test_tuned_and_winner_follow_the_grid(results):
    top = {(r.model, r["rank"]): r for r in results("h09_grid_search")}
    assert set(top) == set(itertools.product(C.TUNING_GRIDS, range(1, 6)))
    for model in C.TUNING_GRIDS:
        assert [top[model, k].mean_cv_f1 for k in range(1, 6)] == sorted((top[model, k].mean_cv_f1 for k in range(1, 6)), reverse=True)
    rows = results("h10_fitted_baseline_vs_tuned")
    assert {(r.model, r.variant) for r in rows} == set(itertools.product(C.TUNING_GRIDS, ("baseline_default", "tuned_best")))
    best = max(rows, key=lambda r: (r.f1, r.roc_auc))
    winner = results("h11_fitted_validation_winner")[0]
    assert (winner.f1, winner.roc_auc) == (best.f1, best.roc_auc)


def test_tuned_model_is_the_grids_first_row(spark, vectors, monkeypatch):
    monkeypatch.setattr(fitted, "STORE", {})
    monkeypatch.setattr(C, "TUNING_GRIDS", {"RandomForest": {"max_depth": (1, 6)}})
    monkeypatch.setattr(fitted, "TUNED_FOREST", {"n_trees": 3})
    monkeypatch.setattr(fitted, "DEFAULT_FOREST", SMALL)
    fits, fit = [], H.fit_model
    monkeypatch.setattr(fitted.H, "fit_model", lambda df, name, *a, **k: (fits.append(k), fit(df, name, *a, **k))[1])
    rows = fitted.tuned_table(vectors, vectors).collect()
    first = fitted.H.best_params(fitted.searched(vectors, "RandomForest"), [{"max_depth": 1}, {"max_depth": 6}])
    assert fits[-1]["max_depth"] == first["max_depth"] and fits[-1]["n_trees"] == 3 and len(rows) == 2
    assert len(fitted.STORE) == 1  # the second call met the stored grid


def test_curve_has_every_depth(results):
    rows = [r for r in results("h14_validation_curve") if r.model == "RandomForest"]
    assert {r.param_value for r in rows} == {"2", "4", "6", "8", "None"}


def test_open_leaves_equal_a_walk_down_the_trees(vectors):
    rows = D.fit_rows(vectors, H.class_counts(vectors))
    forest = D.DepthForest(D.fit_forest(rows, n_trees=7, batch=3), vectors.sparkSession)
    x = np.random.default_rng(1).random((200, 3))
    x[:, 2] = x[:, 2] > 0.5
    x[:50, 0] = np.resize(forest.threshold[forest.inner & (forest.feature == 0)], 50)  # on the cuts themselves
    tables, shares = forest.tables([0, 1, 3, None])
    for limit, (none, one) in zip((0, 1, 3, D.MAX_DEPTH), D.shares_of(x, tables, shares)):
        leaf = forest.ends(limit)
        want = np.zeros((len(x), 2))
        for i, row in enumerate(x):
            for at in forest.roots:
                while not leaf[at]:
                    at = (forest.left if row[forest.feature[at]] <= forest.threshold[at] else forest.right)[at]
                want[i] += forest.shares[at]
        assert np.allclose(want, np.stack([none, one], 1))
