"""Scalar building blocks as pure Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

MISSING = "missing"


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null (greatest/least would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def floor_at(value: Column, low: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def sigmoid(margin: Column) -> Column:
    """Logistic of a margin limited to +-40, so exp never overflows."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(margin, -40.0, 40.0)))


def at_least(score: Column, threshold: float | Column) -> Column:
    """0/1 decision; the threshold itself counts as positive."""
    return (score >= threshold).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def is_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def mapped(value: Column, table: Mapping[str, int], default: int) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def reasons(rules: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """Join the names of all rules that hold with ';', or return `otherwise`."""
    joined = F.concat_ws(";", *[F.when(test, F.lit(name)) for name, test in rules])
    return F.when(joined == "", F.lit(otherwise)).otherwise(joined)


def category(value: Column) -> Column:
    """Text form of a category; null becomes its own level."""
    return F.coalesce(value.cast("string"), F.lit(MISSING))


def number(value: Column) -> Column:
    """Lenient numeric cast: text that is no number, and NaN, become null."""
    cast = value.try_cast("double")
    return F.when(~F.isnan(cast), cast)


def tidy(value: Column, digits: int = 6) -> Column:
    """Round for stable comparison; adding 0.0 turns -0.0 into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def double(x: float) -> str:
    """SQL text of a double literal."""
    return f"({float(x)!r}D)"


def edges_below_sql(value: str, edges: Sequence[float], inclusive: bool) -> str:
    """How many of the sorted `edges` are < value (or <= value if inclusive).

    The edges are few literals, so the comparison is a balanced tree of CASE that
    code generation turns into nested ifs: log2(len(edges)) tests per row. SQL
    text parses in one call, where a Column tree costs a round trip per node.
    """
    operator = ">=" if inclusive else ">"

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return (
            f"CASE WHEN {value} {operator} {double(edges[mid])} "
            f"THEN {tree(mid + 1, high)} ELSE {tree(low, mid)} END"
        )

    return f"CASE WHEN {value} IS NOT NULL THEN {tree(0, len(edges))} END"


def edges_below(value: str, edges: Sequence[float], inclusive: bool) -> Column:
    return F.expr(edges_below_sql(value, edges, inclusive))


def bin_right_closed(value: str, edges: Sequence[float]) -> Column:
    """Bins (e0, e1], (e1, e2], ... numbered from 1; 0 = at or below e0."""
    return edges_below(value, edges, inclusive=False)


def bin_left_closed_sql(value: str, edges: Sequence[float]) -> str:
    inside = f"{value} BETWEEN {double(edges[0])} AND {double(edges[-1])}"
    below = edges_below_sql(value, edges, inclusive=True)
    return f"CASE WHEN {inside} THEN least(({below}) - 1, {len(edges) - 2}) END"


def bin_left_closed(value: str, edges: Sequence[float]) -> Column:
    """Bins [e0, e1), ..., [e_last-1, e_last] numbered from 0; null outside."""
    return F.expr(bin_left_closed_sql(value, edges))


def equal_edges(bins: int, low: float = 0.0, high: float = 1.0) -> list[float]:
    """bins + 1 evenly spaced edges; the same doubles for every caller."""
    step = (high - low) / bins
    return [low + k * step for k in range(bins)] + [high]


def interval_text(low: Column, high: Column) -> Column:
    """'(lo, hi]' with three decimals."""
    return F.format_string("(%.3f, %.3f]", low, high)


def sorted_json(params: Column) -> Column:
    """A string map as JSON text with its keys in order."""
    entries = F.array_sort(F.map_entries(params))
    return F.to_json(F.map_from_entries(entries))


# --- reproducible randomness -------------------------------------------------
# md5 over (key, seed) gives the same draw on every engine, partitioning and
# retry, which rand() does not.


def hash_text(seed: int | str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))).cast("binary"))


def hash_bits(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """Integer value of `digits` hex characters of a digest."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def hash_uniform(digest: Column, start: int = 1) -> Column:
    """Uniform draw in (0, 1) from eight hex characters."""
    return (hash_bits(digest, start) + F.lit(0.5)) / F.lit(4294967296.0)


def hash_normal(digest: Column) -> Column:
    """Standard normal draw (Box-Muller on two uniforms of one digest)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(hash_uniform(digest, 1)))
    return radius * F.cos(F.lit(6.283185307179586) * hash_uniform(digest, 9))
