"""Perturbation draws as arrays equal those of the plain way."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.digests import leading_bits
from plumbline.operators import explain as X


@pytest.mark.parametrize("length", [0, 1, 46, 50, 70, 130])
def test_digests_equal_hashlib(length):
    heads = np.random.default_rng(length).integers(48, 58, (5, length)).astype(np.uint8)
    tails = [f"f|{d}|42".encode() for d in (0, 7, 10, 99, 100)]
    first, second = leading_bits(heads, tails)
    for i, head in enumerate(heads):
        for j, tail in enumerate(tails):
            text = hashlib.md5(head.tobytes() + tail).hexdigest()
            assert (int(text[:8], 16), int(text[8:16], 16)) == (first[i, j], second[i, j])


def test_array_effects_equal_scored_copies(spark):
    rows = [(i, 0.3 * i if i % 7 else None, float(i % 5)) for i in range(60)] + [(None, 1.5, 2.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    scorer = X.LinearScorer({"a": 0.2, "b": -0.4}, 0.1)
    plain = X.perturbation_effects(df, lambda rows: scorer(rows), "id", ["a", "b"], draws=12)
    found = X.perturbation_effects(df, scorer, "id", ["a", "b"], draws=12)
    key = lambda table: {(r.id, r.feature): r.effect for r in table.collect()}
    want, got = key(plain), key(found)
    assert want.keys() == got.keys() and len(got) == 122
    for k, v in want.items():
        assert (v is None) == (got[k] is None) and (v is None or got[k] == pytest.approx(v, abs=1e-12)), k


def test_permutations_carry_digests_as_bytes(spark):
    rows = spark.range(40).select(F.col("id").alias("row_id"), (F.col("id") * 1.0).alias("a"))
    permuted = X.permuted_rows(rows, "row_id", ["a"], repeats=2, digits=1)
    plan = permuted._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan
    for r in range(2):
        order = sorted(range(40), key=lambda i: hashlib.md5(f"{i}|42|{r}".encode()).hexdigest())
        want = {i: float(order[(n + 1) % 40]) for n, i in enumerate(order)}
        assert {x.row_id: x["__other"]["a"] for x in permuted.where(F.col("repeat_no") == r).collect()} == want
