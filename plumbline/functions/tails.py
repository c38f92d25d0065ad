"""Upper-tail probabilities of two test statistics, written as series.

They are evaluated once per (window, feature) row, so the terms of a higher-order
`aggregate` cost nothing beside the scan. Arguments are SQL text; the variables of the lambdas
have names no column will have, as they would hide it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

LOG_GAMMA_1_5 = -0.12078223763524522  # ln(sqrt(pi) / 2)
KS_TERMS = 100


def kolmogorov_upper_tail(distance: str, n: str, m: str, terms: int = KS_TERMS) -> Column:
    """Asymptotic p-value of a two-sample distance.

    2 * sum_k (-1)^(k-1) * exp(-2 k^2 x^2) with x^2 = D^2 nm/(n+m). Below
    x = 0.2 the tail is 1 to twelve digits while the series needs ever more
    terms, so 1 is returned there.
    """
    x2 = f"({distance} * {distance} * (double({n}) * double({m}) / (double({n}) + double({m}))))"
    series = (
        f"2D * aggregate(sequence(1, {terms}), 0D, "
        f"(__acc, __i) -> __acc + CASE WHEN __i % 2 = 1 THEN 1D ELSE -1D END * exp(-2D * __i * __i * {x2}))"
    )
    return F.expr(f"CASE WHEN {x2} < 0.04D THEN 1D ELSE least(greatest({series}, 0D), 1D) END")


def chi2_upper_tail(statistic: str, df: str) -> Column:
    """Q(df/2, statistic/2), the upper regularised gamma function.

    Up to h = a + 1 it is 1 minus the power series of P, beyond that Lentz's continued
    fraction of Q. Both settle within a few sqrt(a) steps, so their number follows the
    degrees of freedom. The factor h^a e^-h / Gamma(a) is formed from logs: by Stirling's
    series around h = a from a = 20, by sums of logs below.
    """
    a, h = f"(double({df}) / 2D)", f"({statistic} / 2D)"
    steps = f"sequence(1, 200 + int(12D * sqrt({a})))"
    half = f"CASE WHEN {df} % 2 = 1 THEN 0.5D ELSE 0D END"
    base = f"CASE WHEN {df} % 2 = 1 THEN {LOG_GAMMA_1_5}D ELSE 0D END"
    # ln Gamma(a + 1) of a small a, and from it ln Gamma(a)
    logs = (
        f"CASE WHEN {df} >= 2 THEN aggregate(sequence(1, least(20, greatest(1, int(floor({a}))))), 0D, "
        f"(__acc, __i) -> __acc + ln(__i + {half})) ELSE 0D END"
    )
    small = f"({a} * ln({h}) - {h} - ({base}) - ({logs}) + ln({a}))"
    stirling = f"(1D / (12D * {a}) - 1D / (360D * pow({a}, 3)) + 1D / (1260D * pow({a}, 5)))"
    large = f"({a} * (log1p(({h} - {a}) / {a}) - ({h} - {a}) / {a}) + 0.5D * ln({a} / {2 * math.pi!r}D) - {stirling})"
    factor = f"exp(CASE WHEN {a} >= 20D THEN {large} ELSE {small} END)"
    series = (
        f"aggregate({steps}, named_struct('term', 1D / {a}, 'total', 1D / {a}), "
        f"(__acc, __i) -> named_struct('term', __acc.term * {h} / ({a} + __i), "
        f"'total', __acc.total + __acc.term * {h} / ({a} + __i)), __acc -> __acc.total)"
    )
    first = f"({h} + 1D - {a})"
    num, den = f"(__i * ({a} - __i))", "(__acc.b + 2D)"
    d, c = f"(1D / ({num} * __acc.d + {den}))", f"({den} + {num} / __acc.c)"
    fraction = (
        f"aggregate({steps}, named_struct('b', {first}, 'c', 1e300D, 'd', 1D / {first}, 'f', 1D / {first}), "
        f"(__acc, __i) -> named_struct('b', {den}, 'c', {c}, 'd', {d}, 'f', __acc.f * {c} * {d}), __acc -> __acc.f)"
    )
    return F.expr(
        f"CASE WHEN {df} <= 0 OR {statistic} <= 0 THEN 1D "
        f"WHEN {h} < {a} + 1D THEN least(greatest(1D - {factor} * {series}, 0D), 1D) "
        f"ELSE least(greatest({factor} * {fraction}, 0D), 1D) END"
    )
