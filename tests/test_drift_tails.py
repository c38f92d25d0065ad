"""Chi-square tails against exact decimal sums, and drift cases that once went wrong."""

import math
import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from plumbline.functions import chi2_upper_tail
from plumbline.operators import drift as D

PI = Decimal("3.14159265358979323846264338327950288419716939937510582097494")


def exact_tail(statistic, df):
    """Finite sum for even degrees of freedom, 1 minus the lower series in 60 digits for odd ones."""
    getcontext().prec = 60
    h = Decimal(statistic) / 2
    if df % 2 == 0:
        term = total = (-h).exp()
        for k in range(1, df // 2):
            term = term * h / k
            total += term
        return total
    a, gamma = Decimal(df) / 2, PI.sqrt()
    for i in range((df + 1) // 2):
        gamma *= Decimal(i) + Decimal("0.5")
    term = (a * h.ln() - h).exp() / gamma
    total, n = term, 1
    while n < 5 or term > total * Decimal(10) ** -58:
        term = term * h / (a + n)
        total, n = total + term, n + 1
    return 1 - total


def test_chi_square_tail(spark):
    cases = [(38000.0, 20000), (60000.0, 50000), (20500.0, 20000), (3000.0, 2000), (700.0, 701), (3.0, 2), (5.5, 3), (1.0, 1), (100.0, 1), (0.01, 5), (19900.0, 20000), (2000.0, 2001), (45.0, 41)]
    df = spark.createDataFrame(cases, "s double, df long").select("*", chi2_upper_tail("s", "df").alias("q"))
    for r in df.collect():
        assert r.q == pytest.approx(float(exact_tail(r.s, r.df)), rel=1e-9, abs=1e-300), (r.s, r.df)


def windows_of(spark):
    rng = random.Random(5)
    rows = [(w, rng.choice("aab" if w < 0 else "abcd"), 0.0 if rng.random() < 0.95 else rng.uniform(1, 2000 + 500 * (w == 3))) for w in (-1, 2, 3) for _ in range(400)]
    return spark.createDataFrame(rows, "window_id long, letter string, amount double").withColumn("scenario", F.lit("x"))


def brute_category(ref, cur):
    levels = sorted(set(ref) | set(cur))
    nr, nc = len(ref), len(cur)
    fix = 0.5 if len(levels) == 2 else 0.0
    chi = psi = 0.0
    for level in levels:
        r, c = ref.count(level), cur.count(level)
        for seen, size in ((r, nr), (c, nc)):
            e = (r + c) * size / (nr + nc)
            chi += (abs(seen - e) - min(fix, abs(seen - e))) ** 2 / e
        a, b = max(r / nr, 1e-6), max(c / nc, 1e-6)
        psi += (b - a) * math.log(b / a)
    return chi, len(levels) - 1, psi


@pytest.mark.parametrize("letters", ["abcd", "ab", "az"])
def test_categories_equal_the_full_table_and_negative_ids_stay(spark, letters):
    from plumbline import constants as C

    rng = random.Random(1)
    ref_rows = [rng.choice(letters) for _ in range(300)]
    reference = spark.createDataFrame([(x,) for x in ref_rows], "letter string")
    windows = windows_of(spark).where(F.col("letter").isin(*letters[:2], "a", "b"))
    rows = windows.collect()
    out = {r.window_id: r for r in D.categorical_drift(reference, windows, ["letter"]).collect()}
    assert set(out) == {-1, 2, 3}
    for w, r in out.items():
        chi, df, psi = brute_category(ref_rows, [x.letter for x in rows if x.window_id == w])
        assert r.df == df and r.chi2 == pytest.approx(chi, rel=1e-9)
        if C.PSI_FLOOR == 1e-6:
            assert r.psi == pytest.approx(psi, rel=1e-9)


def test_zero_inflated_amounts(spark):
    """Collapsed quantile edges: equal bins over the joint range of each window."""
    from plumbline import constants as C

    windows = windows_of(spark)
    reference = windows.where("window_id = 2").select("amount")
    profile = D.fit_reference(reference, ["amount"], windows, buckets=16)
    assert profile.flat == ["amount"]
    out = {r.window_id: r.psi for r in D.numeric_drift(reference, windows, profile).collect()}
    ref = [r.amount for r in reference.collect()]
    for w in (-1, 2, 3):
        cur = [r.amount for r in windows.where(F.col("window_id") == w).collect()]
        low, high = min(ref + cur), max(ref + cur)
        step, psi = (high - low) / 10, 0.0
        place = lambda v: sum(v >= low + k * step for k in range(1, 10))  # noqa: B023, E731
        for b in range(10):
            r = max(sum(place(v) == b for v in ref) / len(ref), C.PSI_FLOOR)
            c = max(sum(place(v) == b for v in cur) / len(cur), C.PSI_FLOOR)
            psi += (c - r) * math.log(c / r)
        assert out[w] == pytest.approx(psi, abs=1e-9)
