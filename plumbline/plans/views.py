"""Views the queries share, once for Spark and once as SQL text.

`scored`: lines with a label and a deterministic score.
`orders_wide`: one row per order with line totals (null for orders without lines).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plumbline.plans.catalogue import Tables

# --- SQL text helpers ----------------------------------------------------------


def num(x: float) -> str:
    """A literal that is the same double on both engines."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + CAST(0 AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


def right_closed(expr: str, edges: Sequence[float]) -> str:
    return "(" + " + ".join(f"CAST({expr} > {num(e)} AS INT)" for e in edges) + ")"


# --- scored ---------------------------------------------------------------------

SCORED = """scored AS (
  SELECT CAST(l_returnflag = 'R' AS INT) AS y,
         CAST((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS score,
         'v' || CAST(l_linenumber % 3 AS VARCHAR) AS variant,
         l_linestatus AS dataset, l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
         CAST(year(l_shipdate) AS INT) AS window_id, CAST(month(l_shipdate) % 3 AS INT) AS fold,
         'm' || CAST(l_linenumber % 2 AS VARCHAR) AS model,
         CASE WHEN year(l_shipdate) <= 1997 THEN 'train' ELSE 'validation' END AS split
  FROM lineitem)"""


def scored(t: Tables) -> DataFrame:
    code = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 7) % 1001
    return t("lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (code.cast("double") / F.lit(1000.0)).alias("score"),
        F.concat(F.lit("v"), (F.col("l_linenumber") % 3).cast("string")).alias("variant"),
        F.col("l_linestatus").alias("dataset"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.year("l_shipdate").alias("window_id"),
        (F.month("l_shipdate") % 3).alias("fold"),
        F.concat(F.lit("m"), (F.col("l_linenumber") % 2).cast("string")).alias("model"),
        F.when(F.year("l_shipdate") <= 1997, F.lit("train")).otherwise(F.lit("validation")).alias("split"),
    )


# --- orders_wide ------------------------------------------------------------------

ORDERS_WIDE = """lines AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS quantity,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS discount,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS tax,
         CAST(sum(CAST(l_returnflag = 'R' AS INT)) AS BIGINT) AS returned
  FROM lineitem GROUP BY l_orderkey),
orders_wide AS (
  SELECT o_orderkey AS row_id, o_totalprice / CAST(1000 AS DOUBLE) AS total_k,
         n_lines, quantity, discount, tax, o_orderpriority AS priority, c_mktsegment AS segment,
         CAST(coalesce(returned, 0) >= 2 AS INT) AS y, CAST(year(o_orderdate) AS INT) AS yr
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

NUMERIC = ["total_k", "n_lines", "quantity", "discount", "tax"]
CATEGORICAL = ["priority", "segment"]


def orders_wide(t: Tables) -> DataFrame:
    count = F.count(F.lit(1)).cast("double")
    lines = t("lineitem").groupBy("l_orderkey").agg(
        count.alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        (F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).cast("double") / count).alias("discount"),
        (F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).cast("double") / count).alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    joined = (
        t("orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    return joined.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("total_k"),
        "n_lines",
        "quantity",
        "discount",
        "tax",
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        (F.coalesce("returned", F.lit(0)) >= 2).cast("int").alias("y"),
        F.year("o_orderdate").alias("yr"),
    )


# --- yearly windows of lines ---------------------------------------------------------

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CATEGORICAL = ["l_returnflag", "l_linestatus"]
REFERENCE_YEAR = 1995


def _after(year: int):
    """First day after a year: a bound that reaches the scan."""
    return F.lit(f"{year + 1}-01-01").cast("date")


def line_reference(t: Tables) -> DataFrame:
    day = F.col("l_shipdate")
    return t("lineitem").where((day >= F.lit(f"{REFERENCE_YEAR}-01-01").cast("date")) & (day < _after(REFERENCE_YEAR)))


def line_windows(t: Tables) -> DataFrame:
    year = F.year("l_shipdate")
    return (
        t("lineitem")
        .where(F.col("l_shipdate") >= _after(REFERENCE_YEAR))
        .withColumns({"window_id": year, "scenario": F.concat(F.lit("y"), year.cast("string"))})
    )
