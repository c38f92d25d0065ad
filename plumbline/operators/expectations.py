"""Checks on audit tables: column contracts, domains, ranges, cardinalities.

Schema checks raise at once. Data checks return one row per check with the number
of violations, so all of them run as aggregates of a single scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def require_columns(df: DataFrame, needed: Sequence[str], label: str = "table") -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks columns {missing}")
    return df


def contract(df: DataFrame, columns: Sequence[str], label: str = "table") -> DataFrame:
    """Ordered projection onto a column contract; missing columns raise."""
    return require_columns(df, columns, label).select(*columns)


def exact_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    return set(df.columns) == set(columns)


def require_rows(df: DataFrame, label: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
    return df


def outside_domain(column: str, allowed: Sequence) -> Column:
    """Rows whose value is null or not allowed."""
    return F.count_if(~F.coalesce(F.col(column).isin(list(allowed)), F.lit(False)))


def missing_from(column: str, required: Sequence) -> Column:
    """How many required values never occur."""
    seen = [F.max(F.coalesce(F.col(column) == v, F.lit(False)).cast("int")) for v in required]
    total = F.lit(len(required))
    for s in seen:
        total = total - F.coalesce(s, F.lit(0))
    return total.cast("bigint")


def outside_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    bad = F.col(column).isNull()
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return F.count_if(bad)


def blank(column: str) -> Column:
    return F.count_if(F.coalesce(F.length(F.trim(F.col(column))), F.lit(0)) == 0)


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, violations) from one aggregate."""
    row = df.agg(*[c.cast("bigint").alias(name) for name, c in checks.items()])
    return row.unpivot([], list(checks), "check_name", "violations")


def group_sizes_off(df: DataFrame, keys: Sequence[str], column: str, expected: int) -> DataFrame:
    """Groups whose number of distinct values is not the expected one."""
    return (
        df.groupBy(*keys).agg(F.count_distinct(column).alias("n_distinct")).where(F.col("n_distinct") != expected)
    )


def orphans(df: DataFrame, parent: DataFrame, keys: Sequence[str], rounded: str | None = None) -> DataFrame:
    """Rows without a partner in `parent`; `rounded` is matched at six decimals."""
    on = list(keys)
    left, right = df, parent.select(*keys, *([rounded] if rounded else []))
    if rounded:
        left = left.withColumn("__match", F.round(rounded, 6))
        right = right.withColumn("__match", F.round(rounded, 6)).drop(rounded)
        on.append("__match")
    return left.join(right.distinct(), on, "left_anti").drop("__match")
