"""The fitted plans ask for the whole job: sizes of their forests, folds, repeats, seeds and grids. test_forests.py runs them."""

import pytest

from plumbline import constants as C
from plumbline.plans import QUERIES, fitted, load_all

load_all()


class Asked(Exception):
    pass


def asked(monkeypatch, query, module, name):
    """What a query passes to an operator; no model is fitted."""

    def stop(*args, **kwargs):
        raise Asked(args, kwargs)

    vectors = lambda t, folds=0: (folds, ["num__a", "cat__b_x"])
    monkeypatch.setattr(fitted, "train_vectors", vectors)
    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Asked) as caught:
        QUERIES[query](None, "/nowhere")
    return caught.value.args


def test_selection_offers_every_feature(monkeypatch):
    args, kwargs = asked(monkeypatch, "f02_forward_selection", fitted.H, "forward_selection")
    assert args == (3, ["num__a", "cat__b_x"]) and kwargs == {"keep": 10}


def test_forests_are_whole(monkeypatch):
    _, kwargs = asked(monkeypatch, "f04_forest_importance", fitted.H, "forest_scores")
    assert kwargs == {"n_trees": 100, "max_depth": None}
    _, kwargs = asked(monkeypatch, "f06_stability_over_seeds", fitted.H, "selection_runs")
    assert list(kwargs["seeds"]) == [0, 1, 2, 3, 4] and kwargs["forest"] == {"n_trees": 50, "max_depth": None}


def test_grid_search_covers_both_models(monkeypatch):
    seen = []
    monkeypatch.setattr(fitted, "tuning_rows", lambda t: ("folds", "valid"))
    monkeypatch.setattr(fitted, "once", lambda label, rows, build: build())
    monkeypatch.setattr(fitted.H, "grid_search", lambda df, name, grid, *a, **k: (seen.append((df, name, grid, k["fixed"])), None))
    monkeypatch.setattr(fitted.H, "top_grid_rows", lambda table, n: None)
    monkeypatch.setattr(fitted.DataFrame, "unionByName", lambda a, b: "both")
    assert QUERIES["h09_grid_search"](None, "/nowhere") == "both"
    assert seen == [("folds", n, C.TUNING_GRIDS[n], {"n_trees": 350} if n == "RandomForest" else {}) for n in ("LogisticRegression", "RandomForest")]
