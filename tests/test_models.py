"""Invariants of fitted models; exact parity with another library is no goal."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import cycle as Y
from plumbline.operators import explain as X
from plumbline.operators import models as H
from plumbline.operators import sampling as S

FOREST = {"n_trees": 8, "max_depth": 4}


@pytest.fixture(scope="module")
def table(spark):
    """900 rows whose label follows income, with nulls and a category."""
    u = (F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("double")) / F.lit(16777216.0)
    df = spark.range(900).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 50 + 20).cast("double").alias("age"),
        F.when(F.col("id") % 20 != 0, (F.col("id") * 7 % 101).cast("double")).alias("income"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int")).alias("segment"),
        u.alias("u"),
    )
    risk = F.coalesce(F.col("income"), F.lit(50.0)) / 101
    return df.withColumn("y", (F.col("u") < risk).cast("int")).drop("u").cache()


def test_unknown_model_raises():
    with pytest.raises(ValueError):
        H.make_estimator("Oracle", 10)


def test_three_models_score_in_range_and_learn(spark, table):
    rows = S.split_three(table, "row_id")
    from plumbline.operators.preprocess import fit_preprocessor

    fit = fit_preprocessor(rows.where("split = 'train'"), ["age", "income"], ["segment"])
    models = {"LogisticRegression": {"class_weight": "balanced"}, "RandomForest": FOREST, "LinearSVC": {"max_iter": 15}}
    out = H.compare_models(rows, fit, models, {"full": None, "one": ["num__income"]}, "t").collect()
    assert len(out) == 12
    assert all(r["roc_auc"] > 0.6 for r in out)


def test_calibrated_variants_stay_probabilities(spark, table):
    from plumbline.operators.preprocess import fit_preprocessor

    rows = S.split_two(table, "row_id")
    train = S.folds(rows.where("split = 'train'"), "row_id", 3)
    fit = fit_preprocessor(train, ["age", "income"], ["segment"])
    scored = H.calibrated_variants(
        fit.vectors(train).select("y", "features", "fold"),
        fit.vectors(rows.where("split = 'test'")).select("row_id", "y", "features"),
        "RandomForest",
        folds=3,
        **FOREST,
    )
    stats = scored.groupBy("variant").agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect()
    assert {r["variant"] for r in stats} == {"uncalibrated", "calibrated_sigmoid", "calibrated_isotonic"}
    assert len({r["n"] for r in stats}) == 1 and all(0.0 <= r["lo"] <= r["hi"] <= 1.0 for r in stats)


def test_elimination_keeps_the_informative_feature(spark, table):
    from plumbline.operators.preprocess import fit_preprocessor

    fit = fit_preprocessor(table, ["age", "income"], ["segment"])
    vectors = fit.vectors(table).select("y", "features")
    scores, kept = H.recursive_elimination(vectors, fit.names, keep=1)
    assert kept == ["num__income"]
    ranks = sorted(round(1 / r["score"]) for r in scores.collect())
    assert ranks == [1, 2, 3, 4, 5]


def test_permutation_finds_the_weight(spark, table):
    rows = table.select("row_id", "y", F.coalesce("income", F.lit(50.0)).alias("income"), "age")
    scorer = X.LinearScorer({"income": 0.05, "age": 0.0}, -2.5)
    out = {r["feature"]: r["importance_mean"] for r in X.permutation_importance(rows, scorer, "row_id", ["income", "age"], repeats=2).collect()}
    assert out["income"] > 0.1 and out["age"] == pytest.approx(0.0)
    wide = X.permuted_values(rows, "row_id", ["income"], 1)
    # Nothing is lost or invented by the permutation.
    sums = wide.agg(F.sum("income").alias("a"), F.sum(F.col("__p0")["income"]).alias("b")).first()
    assert sums["a"] == pytest.approx(sums["b"])


def test_dependence_of_a_linear_scorer_rises(spark, table):
    rows = table.select("row_id", "y", F.coalesce("income", F.lit(50.0)).alias("income"))
    curve = X.partial_dependence(rows, X.LinearScorer({"income": 0.05}, -2.5), "income", points=5)
    row = X.dependence_summary(curve).first()
    assert (row["trend"], row["shape"]) == ("increasing", "monotone_up")


def test_full_cycle(spark, table):
    models = {"LogisticRegression": {}, "RandomForest": FOREST}
    out = Y.monitoring_cycle(table, "row_id", ["age", "income"], ["segment"], "t", size=180, models=models)
    drift = out.drift.collect()
    assert len(drift) == 4 * 3
    share = {s: sum(r["drift_flag"] for r in drift if r["scenario"] == s) / 3 for s in ("stable", "covariate", "prior", "combined")}
    assert share["stable"] < 0.35 and share["combined"] > share["stable"]
    assert out.quality.count() == 8
    assert {r["policy_action"] for r in out.decisions.collect()} <= {"observe", "retrain"}
    post = out.retraining.collect()
    assert {r["phase"] for r in post} == {"before_retrain", "after_retrain"} and len(post) == 8
    assert all(r["expected_cost"] >= 0 for r in post)
    with pytest.raises(ValueError):
        Y.post_retrain_comparison(table, {}, [], [], "t", "Other")


def test_joint_regressions_equal_single_fits(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler

    u = lambda c: F.conv(F.substring(F.md5(F.concat(F.lit(c), F.col("id").cast("string"))), 1, 6), 16, 10).cast("double") / 16777216.0
    df = spark.range(900).select(*[u(c).alias(c) for c in "abcd"], u("e").alias("e"), (F.col("id") % 3).cast("int").alias("fold"))
    df = df.withColumn("y", (F.col("e") < 0.1 + 0.7 * F.col("a") - 0.2 * F.col("c")).cast("int"))
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).drop(*"abcde").cache()
    sizes = H.fold_counts(df)
    models = [([0, 2], 1, np.zeros(3)), ([3], 0, np.zeros(2)), ([0, 1, 2, 3], 2, np.full(5, 0.5))]
    for extra in ({}, {"class_weight": "balanced", "C": 0.3}):
        for (columns, k, _), w in zip(models, H.joint_logistic(df, models, sizes, **extra)):
            rest = H.sliced(df, columns).where(F.col("fold") != k)
            one = H.fit_model(rest, "LogisticRegression", **extra)
            assert np.allclose(w, [one.intercept, *one.coefficients.toArray()], atol=1e-4)
    names = [f"f{i}" for i in range(4)]
    plain = H.forward_selection(df, names, keep=2, l1=False)
    counted = []
    chosen = []
    for _ in range(2):
        rates = {}
        for i in (i for i in range(4) if i not in chosen):
            held = H._held_rates(df, [([*chosen, i], k) for k in range(3)], sizes, "fold", 2, {})
            rates[i] = round(float(np.mean(held)), 12)
        chosen.append(max(rates, key=lambda i: (rates[i], -i)))
        counted.append(rates)
    assert {r.feature for r in plain.where("score = 1").collect()} == {names[i] for i in chosen}
