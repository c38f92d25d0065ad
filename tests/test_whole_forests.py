"""Forests on tables of more rows than Spark's estimator is given: every row and every threshold counts."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from plumbline.operators import forests as D
from plumbline.operators import models as H
from plumbline.operators import trees as T
from plumbline.plans import QUERIES, fitted, load_all
from plumbline.session import stage

load_all()
N = 1500


@pytest.fixture(scope="module")
def vectors(spark):
    u = lambda seed: F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), 1, 6), 16, 10).cast("double") / 16777216.0
    df = spark.range(N).select(F.col("id").alias("row_id"), u("a").alias("a"), F.floor(u("b") * 7).alias("b"), (u("c") > 0.5).cast("double").alias("flag"), u("d").alias("d"))
    df = df.withColumn("y", (F.col("d") < 0.3 + 0.4 * F.col("a") * F.col("flag")).cast("int")).withColumn("fold", (F.col("row_id") % 3).cast("int"))
    return stage(VectorAssembler(inputCols=["a", "b", "flag"], outputCol="features").transform(df).drop("a", "b", "flag", "d"), "vectors")


def by_row(df):
    rows = df.select("row_id", "score").toPandas().sort_values("row_id")
    return rows["score"].to_numpy()


def plain_share(x, y, count, weights, path, width, depth, min_leaf, row):
    """Where one row ends in a tree grown by trying every boundary of every drawn feature."""
    drawn = np.argsort(T.mixed(path + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(T.GOLD)), kind="stable")[: int(np.ceil(np.sqrt(width)))]
    ones, zeros = count[y == 1].sum() * weights[1], count[y == 0].sum() * weights[0]
    worth = lambda part: (lambda a, b: (a * a + b * b) / (a + b))(count[part & (y == 1)].sum() * weights[1], count[part & (y == 0)].sum() * weights[0])
    best = None
    if ones and zeros and depth != 0:
        for f in drawn:
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                left = x[:, f] <= low
                if min(count[left].sum(), count[~left].sum()) < min_leaf:
                    continue
                score = worth(left) + worth(~left)
                if score > (best[0] if best else worth(np.ones(len(y), bool)) * (1 + 1e-12)):
                    best = (score, f, (low + high) / 2)
    if best is None:
        return ones / (ones + zeros)
    right = not row[best[1]] <= best[2]
    own = (x[:, best[1]] <= best[2]) != right
    return plain_share(x[own], y[own], count[own], weights, T.mixed(path + np.uint64(1 + right)), width, depth - 1, min_leaf, row)


@pytest.mark.parametrize("weights, depth, min_leaf", [(None, None, 1), ({0: 0.5, 1: 2.0}, 4, 5)])
def test_trees_equal_a_plain_search(vectors, weights, depth, min_leaf):
    rows = T.tree_rows(vectors)
    forest = T.grow_forest(rows, n_trees=2, max_depth=depth, min_samples_leaf=min_leaf, weights=weights, seed=9)
    got = by_row(forest.scored(vectors))
    table = vectors.select("row_id", "y", F.xxhash64("row_id").alias("h"), T.vector_to_array("features").alias("x")).toPandas().sort_values("row_id")
    x, y, digests = np.stack(table["x"]), table["y"].to_numpy(), table["h"].to_numpy().view(np.uint64)
    for i in range(0, N, 50):
        shares = []
        for tree in range(2):
            start = T.start_of(9, tree)
            count = np.searchsorted(T.DRAWS, (T.mixed(digests + start) >> np.uint64(11)) / 2.0**53, "right")
            own = count > 0
            pair = (1.0, 1.0) if weights is None else (weights[0], weights[1])
            shares.append(plain_share(x[own], y[own], count[own], pair, T.mixed(start + np.uint64(1)), 3, -1 if depth is None else depth, min_leaf, x[i]))
        assert got[i] == pytest.approx(np.mean(shares)), i


def test_every_row_is_learnt(vectors):
    """f04, f05, h02, h08, h10, h11, h12, k14, k17 (F5, F6, F8, F9, F11-F13, F15, F16): 600 of the rows would not do."""
    noise = vectors.withColumn("y", (F.xxhash64("row_id") % 2 == 0).cast("int"))
    out = H.apply_model(H.fit_model(noise, "RandomForest", n_trees=40), noise)
    assert out.agg(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0] > 0.85


def test_large_nodes_and_order_change_nothing(vectors, monkeypatch):
    model = H.fit_model(vectors, "RandomForest", n_trees=5, class_weight="balanced")
    want = by_row(H.apply_model(model, vectors))
    shuffled = H.fit_model(vectors.repartition(7, "y"), "RandomForest", n_trees=5, class_weight="balanced")
    assert (by_row(H.apply_model(shuffled, vectors)) == want).all()
    monkeypatch.setattr(T, "LOCAL_CELLS", 300)
    monkeypatch.setattr(T, "PIECE", 256)
    piecewise = H.fit_model(vectors, "RandomForest", n_trees=5, class_weight="balanced")
    assert (by_row(H.apply_model(piecewise, vectors)) == want).all()
    assert np.allclose(piecewise.importances, model.importances) and sum(model.importances) == pytest.approx(1)


def test_files_of_large_tables_equal_memory(vectors):
    rows = T.tree_rows(vectors)
    small, large = T.Ranks(rows.files, rows.width), T.Ranks(rows.files, rows.width, cells=300)
    assert isinstance(large.codes, np.memmap) and (small.codes == large.codes).all()
    monkey = pytest.MonkeyPatch()
    monkey.setattr(T, "PIECE", 128)
    a, b = T.Tree(small, 1, 0, min_leaf=4), T.Tree(large, 1, 0, min_leaf=4)
    monkey.undo()
    x = np.stack([v[small.codes[f]] for f, v in enumerate(small.values)], 1)
    sums = np.zeros((2, 3, N))
    for tree, out in zip((a, b), sums):
        T.walk((tree.feature, tree.left, tree.value, tree.share), x, [1, 4, None], out)
    assert (sums[0] == sums[1]).all() and np.allclose(a.gains, b.gains) and len(a.left) == len(b.left)


def test_depths_equal_separate_fits(vectors):
    """h14 (F14)."""
    model = H.fit_model(vectors, "RandomForest", n_trees=6)
    found = model.depths(vectors, [1, 4, None], ["row_id"]).toPandas()
    for i, depth in enumerate((1, 4, None)):
        alone = H.fit_model(vectors, "RandomForest", n_trees=6, max_depth=depth)
        assert (found[found["depth_no"] == i].sort_values("row_id")["score"].to_numpy() == by_row(alone.scored(vectors))).all()


def test_grid_and_folds_use_all_other_rows(vectors):
    """h09 (F10), h12 (F13)."""
    grid = {"max_depth": (3, None), "min_samples_leaf": (1, 5), "class_weight": (None, "balanced")}
    table, choices = H.grid_search(vectors, "RandomForest", grid, "t", "full", fixed={"n_trees": 4})
    got = {r.param_id: r.mean_cv_accuracy for r in table.collect()}
    for i in (0, 7):
        held = []
        for k in range(3):
            model = H.fit_model(vectors.where(F.col("fold") != k), "RandomForest", n_trees=4, **choices[i])
            out = H.apply_model(model, vectors.where(F.col("fold") == k))
            held.append(out.agg(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0])
        assert got[i] == pytest.approx(np.mean(held)), choices[i]


SMALL = {"n_trees": 2, "max_depth": None}
FORESTS = {
    "f04_forest_importance": 1, "f05_permutation_of_fitted_model": 1, "f06_stability_over_seeds": 5, "h02_random_forest": 1, "h08_comparison_matrix": 3,
    "h09_grid_search": 18, "h10_fitted_baseline_vs_tuned": 20, "h11_fitted_validation_winner": 20, "h12_calibrated_variants": 6, "h14_validation_curve": 1,
    "k14_post_retrain_comparison": 5, "k17_full_cycle_decisions": 1,
}


@pytest.mark.parametrize("name", FORESTS)
def test_queries_draw_no_rows_for_forests(spark, monkeypatch, name):
    """F5-F16: rows outside a held fold are all read by every tree's task."""
    for size in ("FOREST", "SEED_FOREST", "DEFAULT_FOREST", "MONITORED_FOREST"):
        monkeypatch.setattr(fitted, size, SMALL)
    monkeypatch.setattr(fitted, "TUNED_FOREST", {"n_trees": 2})
    monkeypatch.setattr(fitted, "STORE", {})
    monkeypatch.setattr(fitted.C, "VALIDATION_CURVES", {"LogisticRegression": ("C", (1.0,)), "RandomForest": ("max_depth", (2, None))})
    for module in (H, D):
        monkeypatch.setattr(module, "FIT_ROWS", 100)
    bounded, grown, fit_rows, grow = [], [], H.fit_rows, H.grow_forest
    monkeypatch.setattr(H, "fit_rows", lambda df, counts, *a, **k: (bounded.append(sum(counts.values())), fit_rows(df, counts, *a, **k))[1])
    monkeypatch.setattr(H, "grow_forest", lambda rows, **k: (grown.append((rows, k)), grow(rows, **k))[1])
    counted, fit = [], H.fit_model
    monkeypatch.setattr(H, "fit_model", lambda df, name, *a, counts=None, **k: (counted.append((name, df, counts)), fit(df, name, *a, counts=counts, **k))[1])
    QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert not bounded and len(grown) == FORESTS[name]
    for rows, _ in grown:
        assert sum(pq.read_metadata(T.opened(f)[1]).num_rows for f in rows.files) > 100
    for kind, df, counts in counted:
        if kind == "RandomForest" and isinstance(df, T.TreeRows) and counts:
            read = sum(b.num_rows for b in T.Ranks.read(df.files, ["h"], df.held))
            assert read == sum(counts.values())
