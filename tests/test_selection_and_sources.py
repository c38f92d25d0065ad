"""Rankings, feature sets, sampling, preprocessing, sources and expectations."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions import edges_below, equal_edges, reasons, sorted_json
from plumbline.operators import expectations as Q
from plumbline.operators import preprocess as P
from plumbline.operators import sampling as S
from plumbline.operators import selection as G
from plumbline.sources import tables as T

RANKING = "dataset string, method string, feature string, score double, rank int"


def ranking(spark, lists):
    rows = [("d", m, f, 1.0 / (i + 1), i + 1) for m, fs in lists.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(rows, RANKING)


def test_ties_rank_by_name(spark):
    scores = spark.createDataFrame([("d", "b", 1.0), ("d", "a", 1.0), ("d", "c", 2.0)], "dataset string, feature string, score double")
    rows = {r["feature"]: r["rank"] for r in G.rank_scores(scores, ["dataset"]).collect()}
    assert rows == {"c": 1, "a": 2, "b": 3}


def test_agreement_counts_overlap(spark):
    table = ranking(spark, {"RFE": ["a", "b", "c"], "L1_logreg": ["b", "a", "d"], "Permutation": ["x", "y", "z"]})
    rows = {(r["method_a"], r["method_b"], r["top_k"]): (r["overlap_count"], r["jaccard"]) for r in G.method_agreement(table, (2, 3)).collect()}
    assert rows[("L1_logreg", "RFE", 2)] == (2, 1.0)
    assert rows[("L1_logreg", "RFE", 3)] == (2, 0.5)
    assert rows[("L1_logreg", "Permutation", 3)] == (0, 0.0)
    assert len(rows) == 6


def test_robust_set_and_fallback(spark):
    table = ranking(spark, {"RFE": ["a", "b", "c", "d"], "L1_logreg": ["d", "b", "a", "c"]})
    assert {r["feature"] for r in G.robust_set(table, k=4).collect()} == {"a", "b", "c", "d"}
    # Two common features only: the k most frequent are kept instead.
    assert {r["feature"] for r in G.robust_set(table, k=2).collect()} == {"b", "a"}


def test_shortlist_falls_back_to_all_methods(spark):
    table = ranking(spark, {"RFE": ["a", "b", "c"]})
    assert [r["feature"] for r in G.shortlist(table, top_n=2).orderBy("place").collect()] == ["a", "b"]
    assert G.shortlist(table, top_n=2, fallback=False).count() == 0
    with pytest.raises(ValueError):
        G.resolve_set("other", table, table)


def test_one_decision_or_error(spark):
    table = spark.createDataFrame([("d", "m", "full")], "dataset string, model string, selected_feature_set string")
    assert G.decision_of(table, "d", "m").first()["selected_feature_set"] == "full"
    with pytest.raises(ValueError):
        G.decision_of(table, "d", "other")


def labelled(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 4 == 0).cast("int").alias("y"),
        (F.col("id") % 17).cast("double").alias("a"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("double")).alias("b"),
        F.element_at(F.array(F.lit("p"), F.lit("q"), F.lit("r")), (F.col("id") % 3 + 1).cast("int")).alias("c"),
    )


def test_splits_have_exact_shares(spark):
    rows = S.split_three(labelled(spark), "row_id").groupBy("y", "split").count().collect()
    counts = {(r["y"], r["split"]): r["count"] for r in rows}
    assert counts[(1, "test")] == 20 and counts[(1, "validation")] == 20 and counts[(1, "train")] == 60
    assert counts[(0, "test")] == 60 and counts[(0, "train")] == 180


def test_folds_are_even(spark):
    counts = [r["count"] for r in S.folds(labelled(spark), "row_id", 5).groupBy("y", "fold").count().collect()]
    assert sorted(counts) == [20] * 5 + [60] * 5


def test_draw_repeats_only_when_short(spark):
    df = labelled(spark)
    exact = S.draw(df.where("y = 1"), "row_id", 50)
    assert exact.count() == 50 and exact.select("row_id").distinct().count() == 50
    more = S.draw(df.where("y = 1"), "row_id", 150)
    assert more.count() == 150 and more.select("draw_no").distinct().count() == 150
    assert more.select("row_id").distinct().count() <= 100


def test_windows_have_equal_size_and_raised_prior(spark):
    windows = S.monitoring_windows(labelled(spark), "row_id", ["a", "b"], ["c"], size=100)
    rows = {r["scenario"]: r for r in windows.groupBy("scenario").agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.avg("a").alias("a"), F.count("b").alias("b")).collect()}
    assert {r["n"] for r in rows.values()} == {100}
    assert rows["prior"]["pos"] == 75 and rows["combined"]["pos"] == 75
    assert rows["covariate"]["pos"] == rows["stable"]["pos"]
    assert rows["covariate"]["a"] > rows["stable"]["a"] and rows["covariate"]["b"] == 100
    with pytest.raises(ValueError):
        S.monitoring_windows(labelled(spark), "row_id", ["a"], size=39)
    with pytest.raises(ValueError):
        S.monitoring_windows(labelled(spark).where("y = 0"), "row_id", ["a"], size=100)


def test_preprocessor_handles_nulls_and_unseen_levels(spark):
    import numpy as np

    train = labelled(spark)
    fit = P.fit_preprocessor(train, ["a", "b"], ["c"])
    values = [r["b"] for r in train.collect()]
    median = float(np.median([v for v in values if v is not None]))
    filled = np.array([median if v is None else v for v in values])
    assert fit.medians["b"] == median
    assert fit.means["b"] == pytest.approx(filled.mean()) and fit.scales["b"] == pytest.approx(filled.std())
    assert fit.names == ["num__a", "num__b", "cat__c_p", "cat__c_q", "cat__c_r"]
    odd = spark.createDataFrame([(1, 2.0, None, "zzz")], "row_id int, a double, b double, c string")
    vector = fit.vectors(odd).first()["features"].toArray()
    assert list(vector[2:]) == [0.0, 0.0, 0.0]
    assert list(fit.vectors(odd, ["cat__c_q", "num__a"]).first()["features"].toArray())[1] == vector[0]
    with pytest.raises(ValueError):
        fit.vectors(odd, ["nothing"])
    wide = fit.columns(odd, ["num__a", "gone"]).first()
    assert wide["gone"] == 0.0


def test_feature_table_needs_target(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    T.write_audit(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    with pytest.raises(ValueError):
        T.read_feature_table(spark, path)
    assert T.read_feature_table(spark, path, "a int, b int", target="b").count() == 1
    assert T.read_registry(spark, {"x": str(tmp_path / "none.csv")}, skip_missing=True) == {}
    with pytest.raises(FileNotFoundError):
        T.read_audit(spark, [str(tmp_path / "none.csv")])


def test_feature_sets_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "sets.json"
    path.write_text(json.dumps({"d": {"full": ["b", "a"], "short": ["a"]}}), encoding="utf-8-sig")
    rows = [tuple(r) for r in T.read_feature_sets(spark, str(path)).orderBy("set_name", "position").collect()]
    assert rows == [("d", "full", 0, "b"), ("d", "full", 1, "a"), ("d", "short", 0, "a")]


def test_expectations(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 1.5), (None, None)], "k string, v double")
    checks = {"domain": Q.outside_domain("k", ["a"]), "range": Q.outside_range("v", 0.0, 1.0), "blank": Q.blank("k")}
    assert {r[0]: r[1] for r in Q.violations(df, checks).collect()} == {"domain": 2, "range": 2, "blank": 1}
    assert Q.orphans(df.dropna(), df.where("k = 'a'"), ["k"], rounded="v").first()["k"] == "b"
    with pytest.raises(ValueError):
        Q.contract(df, ["k", "zzz"])
    with pytest.raises(ValueError):
        Q.require_rows(df.limit(0))


def test_small_expressions(spark):
    edges = equal_edges(10)
    assert edges[3] == 0.30000000000000004 and edges[-1] == 1.0
    df = spark.createDataFrame([(0.0,), (0.1,), (0.35,), (1.0,), (None,)], "v double")
    counts = [r[0] for r in df.select(edges_below("v", edges, False)).collect()]
    assert counts == [0, 1, 4, 10, None]
    row = spark.range(1).select(
        reasons([("a", F.lit(True)), ("b", F.lit(False)), ("c", F.lit(True))], "none").alias("r"),
        sorted_json(F.create_map(F.lit("z"), F.lit("1"), F.lit("a"), F.lit("2"))).alias("j"),
    ).first()
    assert (row["r"], row["j"]) == ("a;c", '{"a":"2","z":"1"}')
