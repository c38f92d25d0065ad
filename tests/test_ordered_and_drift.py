"""Ordered aggregation and drift statistics against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import chi2_upper_tail, kolmogorov_upper_tail
from plumbline.operators import drift as D
from plumbline.operators import ordered as O


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else (float(v) if not isinstance(v, str) else v) for v in r) for r in zip(*columns.values())]
    kinds = ["string" if isinstance(next(v for v in c if v is not None), str) else "double" for c in columns.values()]
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


@pytest.mark.parametrize("buckets", [1, 4, 37])
def test_quantiles_match_numpy_for_any_cuts(spark, buckets):
    rng = np.random.default_rng(1)
    a = np.round(rng.lognormal(size=700), 3)
    b = np.where(rng.random(700) < 0.4, 5.0, np.round(rng.normal(size=700), 2))
    df = frame(spark, a=a, b=b)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = O.collect_quantiles(df, ["a", "b"], probs, O.range_cuts(df, ["a", "b"], buckets))
    assert found["a"] == pytest.approx(list(np.quantile(a, probs)), abs=1e-9)
    assert found["b"] == pytest.approx(list(np.quantile(b, probs)), abs=1e-9)


def test_bad_cuts_only_cost_balance(spark):
    a = list(range(50))
    df = frame(spark, a=a)
    for cuts in ([], [-5.0], [48.5], [10.0, 10.5, 11.0]):
        found = O.collect_quantiles(df, ["a"], [0.3, 0.5], {"a": cuts})
        assert found["a"] == pytest.approx(list(np.quantile(a, [0.3, 0.5])))


def test_hashed_rank_is_a_permutation(spark):
    from plumbline.operators.sampling import ranked

    df = spark.range(500).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    rows = ranked(df, "id", ["y"], digits=2).collect()
    for label in (0, 1):
        ranks = sorted(r["rank_no"] for r in rows if r["y"] == label)
        assert ranks == list(range(1, len(ranks) + 1))
    again = {r["id"]: r["rank_no"] for r in ranked(df.repartition(7), "id", ["y"], digits=1).collect()}
    assert again == {r["id"]: r["rank_no"] for r in rows}


def brute_ks(a, b):
    grid = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.abs(fa - fb).max()


def brute_psi(a, b, bins=10):
    edges = np.unique(np.quantile(a, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        low, high = min(a.min(), b.min()), max(a.max(), b.max())
        if np.isclose(low, high):
            return 0.0
        edges = np.linspace(low, high, bins + 1)
    ha, hb = np.histogram(a, edges)[0], np.histogram(b, edges)[0]
    if not ha.sum() or not hb.sum():
        return 0.0
    ra, rb = np.clip(ha / ha.sum(), 1e-6, None), np.clip(hb / hb.sum(), 1e-6, None)
    return float(((rb - ra) * np.log(rb / ra)).sum())


def test_numeric_drift_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 400
    reference = {
        "smooth": np.round(rng.normal(size=n), 3),
        "hot": np.where(rng.random(n) < 0.4, 1.0, np.round(rng.random(n), 2)),
        "flat": np.where(rng.random(n) < 0.97, 2.0, 3.0),
        "constant": np.full(n, 4.0),
    }
    windows = {
        1: {k: np.roll(v, 5)[:150] for k, v in reference.items()},
        2: {
            "smooth": np.round(rng.normal(0.8, 2.0, 150), 3),
            "hot": np.where(rng.random(150) < 0.8, 1.0, np.round(rng.random(150) * 3, 2)),
            "flat": np.where(rng.random(150) < 0.5, 2.0, 5.0),
            "constant": np.full(150, 4.0),
        },
    }
    ref = frame(spark, **reference)
    parts = [
        frame(spark, **w).withColumns({"window_id": F.lit(i), "scenario": F.lit(f"s{i}")}) for i, w in windows.items()
    ]
    cur = parts[0].unionByName(parts[1])
    profile = D.fit_reference(ref, list(reference), cur, buckets=6)
    assert set(profile.flat) == {"flat", "constant"}
    rows = D.numeric_drift(ref, cur, profile).collect()
    assert len(rows) == 8
    for r in rows:
        a, b = reference[r["feature"]], windows[r["window_id"]][r["feature"]]
        assert (r["n_ref"], r["n_cur"]) == (n, 150)
        assert r["ks"] == pytest.approx(brute_ks(a, b), abs=1e-12), r
        assert r["psi"] == pytest.approx(brute_psi(a, b), abs=1e-9), r


def test_empty_feature_of_a_window_is_no_drift(spark):
    ref = frame(spark, a=[1.0, 2.0, 3.0, 4.0] * 10, b=[1.0, 2.0, 3.0, 4.0] * 10)
    cur = frame(spark, a=[1.0, 2.0], b=[1.0, 2.0]).withColumns(
        {"b": F.lit(None).cast("double"), "window_id": F.lit(1), "scenario": F.lit("s")}
    )
    rows = {r["feature"]: r for r in D.drift_audit(ref, cur, ["a", "b"]).collect()}
    assert (rows["b"]["statistic"], rows["b"]["p_value"], rows["b"]["effect_size"]) == (0.0, 1.0, 0.0)
    assert rows["b"]["drift_flag"] is False


def test_feature_that_the_reference_lacks_is_no_drift(spark):
    ref = frame(spark, a=[1.0, 2.0, 3.0, 4.0] * 10).withColumn("b", F.lit(None).cast("double"))
    cur = frame(spark, a=[1.0, 2.0], b=[7.0, 9.0]).withColumns({"window_id": F.lit(1), "scenario": F.lit("s")})
    rows = {r["feature"]: r for r in D.drift_audit(ref, cur, ["a", "b"]).collect()}
    assert (rows["b"]["statistic"], rows["b"]["p_value"], rows["b"]["effect_size"]) == (0.0, 1.0, 0.0)
    assert rows["b"]["drift_flag"] is False and rows["a"]["statistic"] == 0.5


def test_categorical_drift_matches_hand_counts(spark):
    ref = frame(spark, c=["x"] * 30 + ["y"] * 20 + [None] * 10, two=["p"] * 40 + ["q"] * 20, one=["k"] * 60)
    cur = frame(spark, c=["x"] * 10 + ["w"] * 20, two=["p"] * 10 + ["q"] * 20, one=["k"] * 30).withColumns(
        {"window_id": F.lit(1), "scenario": F.lit("s")}
    )
    rows = {r["feature"]: r for r in D.categorical_drift(ref, cur, ["c", "two", "one"]).collect()}

    def chi2(table, yates):
        table = np.array(table, float)
        expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
        off = np.abs(table - expected)
        if yates:
            off -= np.minimum(0.5, off)
        return (off**2 / expected).sum()

    assert rows["c"]["levels"] == 4
    assert rows["c"]["chi2"] == pytest.approx(chi2([[30, 20, 10, 0], [10, 0, 0, 20]], False))
    assert rows["two"]["chi2"] == pytest.approx(chi2([[40, 20], [10, 20]], True))
    assert (rows["one"]["chi2"], rows["one"]["df"]) == (0.0, 0)


def test_tails(spark):
    cases = spark.createDataFrame(
        [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (0.0, 0), (5000.0, 4)],
        "s double, k int",
    )
    values = [r[0] for r in cases.select(chi2_upper_tail("s", "k")).collect()]
    assert values[:3] == pytest.approx([0.05] * 3, abs=1e-12)
    assert values[3:] == [1.0, 0.0]
    one = spark.range(1).select(
        kolmogorov_upper_tail("0.0457423D", "315", "220").alias("a"),
        kolmogorov_upper_tail("0D", "315", "220").alias("b"),
        kolmogorov_upper_tail("1D", "315", "220").alias("c"),
    ).first()
    assert one["a"] == pytest.approx(0.949218, abs=1e-6)
    assert one["b"] == 1.0 and one["c"] < 1e-50 and not math.isnan(one["c"])


def test_bad_input_raises(spark):
    with pytest.raises(ValueError):
        D.drift_audit(frame(spark, a=[1.0]), frame(spark, a=[1.0]), [])
