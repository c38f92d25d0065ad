"""Scalar expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from plumbline import functions as P
from plumbline.plans.catalogue import query
from plumbline.plans.views import SCORED, num, rnd, scored
from plumbline.operators.metrics import to_long, to_wide

KEY = "l_orderkey, l_linenumber"
MARGIN = f"(l_quantity * {num(2.0)} - {num(45.0)})"


@query("b03_filters", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R') AND l_linenumber = 2")
def _(t):
    chosen = (F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("A", "R") & (F.col("l_linenumber") == 2)
    return t("lineitem").where(chosen).select("l_orderkey", "l_quantity")


@query(
    "b04_range_and_rounded_match",
    f"SELECT l_orderkey, l_discount FROM lineitem WHERE l_discount BETWEEN {num(0.02)} AND {num(0.06)} AND round(l_discount, 6) = round({num(0.05)}, 6)",
)
def _(t):
    chosen = F.col("l_discount").between(0.02, 0.06) & (F.round("l_discount", 6) == F.round(F.lit(0.05), 6))
    return t("lineitem").where(chosen).select("l_orderkey", "l_discount")


@query(
    "b05_derived_columns",
    f"SELECT o_orderkey AS row_id, 'orders' AS dataset, {rnd('o_totalprice / 1000')} AS total_k FROM orders",
)
def _(t):
    named = t("orders").withColumnRenamed("o_orderkey", "row_id").withColumn("dataset", F.lit("orders"))
    return named.withColumn("total_k", P.tidy(F.col("o_totalprice") / 1000)).select("row_id", "dataset", "total_k")


@query(
    "b06_lenient_cast",
    r"""SELECT doc_id, TRY_CAST(regexp_extract(text, '[0-9]+(\.[0-9]+)?') AS DOUBLE) AS first_number FROM documents WHERE TRY_CAST(regexp_extract(text, '[0-9]+(\.[0-9]+)?') AS DOUBLE) IS NOT NULL
    UNION ALL SELECT event_id, TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE) FROM events""",
)
def _(t):
    docs = t("documents").select("doc_id", P.number(F.regexp_extract("text", r"[0-9]+(\.[0-9]+)?", 0)).alias("first_number"))
    inner = F.regexp_extract("props", r"([0-9]+)", 1)
    events = t("events").select(F.col("event_id").alias("doc_id"), P.number(inner).alias("first_number"))
    return docs.dropna(subset=["first_number"]).unionByName(events)


@query("b07_missing_category", "SELECT o_orderkey, coalesce(CAST(nullif(o_custkey % 3, 0) AS VARCHAR), 'missing') AS band FROM orders")
def _(t):
    band = F.nullif(F.col("o_custkey") % 3, F.lit(0))
    return t("orders").select("o_orderkey", P.category(band).alias("band"))


@query(
    "b08_clip",
    f"SELECT {KEY}, least(greatest(l_tax, {num(0.02)}), {num(0.05)}) AS clipped, greatest(l_tax, {num(1e-6)}) AS floored FROM lineitem",
)
def _(t):
    tax = F.col("l_tax")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", P.clip(tax, 0.02, 0.05).alias("clipped"), P.floor_at(tax, 1e-6).alias("floored")
    )


@query("b09_sigmoid", f"SELECT {KEY}, {rnd(f'1 / (1 + exp(-least(greatest({MARGIN}, -40), 40)))', 9)} AS score FROM lineitem")
def _(t):
    margin = F.col("l_quantity") * 2.0 - 45.0
    return t("lineitem").select("l_orderkey", "l_linenumber", P.tidy(P.sigmoid(margin), 9).alias("score"))


@query("b10_binarise", f"WITH {SCORED} SELECT dataset, variant, CAST(sum(CAST(score >= {num(0.3)} AS INT)) AS BIGINT) AS hits FROM scored GROUP BY ALL")
def _(t):
    hit = P.at_least(F.col("score"), 0.3)
    return scored(t).groupBy("dataset", "variant").agg(F.sum(hit).alias("hits"))


@query("b11_value_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 99 END AS priority FROM orders")
def _(t):
    return t("orders").select("o_orderkey", P.mapped(F.col("o_orderstatus"), {"F": 0, "O": 1}, 99).alias("priority"))


@query("b12_gaps", f"SELECT {KEY}, {rnd('l_discount - l_tax')} AS gap, {rnd('abs(l_discount - l_tax)')} AS abs_gap FROM lineitem")
def _(t):
    gap = F.col("l_discount") - F.col("l_tax")
    return t("lineitem").select("l_orderkey", "l_linenumber", P.tidy(gap).alias("gap"), P.tidy(F.abs(gap)).alias("abs_gap"))


@query(
    "b13_close_match",
    f"SELECT {KEY}, abs(l_discount * 3 - l_tax * 3) <= {num(1e-8)} + {num(1e-5)} * abs(l_tax * 3) AS same FROM lineitem",
)
def _(t):
    same = P.is_close(F.col("l_discount") * 3, F.col("l_tax") * 3)
    return t("lineitem").select("l_orderkey", "l_linenumber", same.alias("same"))


REASON = f"""concat_ws(';', CASE WHEN l_quantity >= 40 THEN 'bulk' END, CASE WHEN l_discount >= {num(0.08)} THEN 'cheap' END,
  CASE WHEN l_tax <= {num(0.01)} THEN 'low_tax' END)"""


@query("b14_reasons", f"SELECT {KEY}, CASE WHEN {REASON} = '' THEN 'none' ELSE {REASON} END AS reason FROM lineitem")
def _(t):
    rules = [
        ("bulk", F.col("l_quantity") >= 40),
        ("cheap", F.col("l_discount") >= 0.08),
        ("low_tax", F.col("l_tax") <= 0.01),
    ]
    return t("lineitem").select("l_orderkey", "l_linenumber", P.reasons(rules, "none").alias("reason"))


@query(
    "b16_interval_text",
    "SELECT o_orderkey, '(' || printf('%.3f', o_custkey / CAST(8 AS DOUBLE)) || ', ' || printf('%.3f', (o_custkey + 1) / CAST(8 AS DOUBLE)) || ']' AS segment FROM orders",
)
def _(t):
    low = F.col("o_custkey").cast("double") / 8.0
    high = (F.col("o_custkey") + 1).cast("double") / 8.0
    return t("orders").select("o_orderkey", P.interval_text(low, high).alias("segment"))


@query(
    "b17_wide_to_long",
    f"""SELECT o_orderkey, metric, {rnd('value')} AS value FROM (SELECT o_orderkey, o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS cust FROM orders)
    UNPIVOT (value FOR metric IN (price, cust))""",
)
def _(t):
    rows = t("orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"))
    return to_long(rows, ["o_orderkey"], ["price", "cust"]).withColumn("value", P.tidy(F.col("value")))


@query(
    "b18_long_to_wide",
    f"""WITH {SCORED} SELECT dataset, variant, {rnd("avg(CASE WHEN split = 'train' THEN score END)")} AS train_score,
    {rnd("avg(CASE WHEN split = 'validation' THEN score END)")} AS validation_score FROM scored GROUP BY dataset, variant""",
)
def _(t):
    wide = to_wide(scored(t), ["dataset", "variant"], "split", ["train", "validation"], ["score"])
    names = ("train_score", "validation_score")
    return wide.select("dataset", "variant", *[P.tidy(F.col(c)).alias(c) for c in names])


@query("b19_log_exp_square", f"SELECT {KEY}, {rnd('ln(l_quantity) + exp(-l_quantity) + power(l_discount, 2)', 9)} AS mixed FROM lineitem")
def _(t):
    q = F.col("l_quantity")
    mixed = F.log(q) + F.exp(-q) + F.pow("l_discount", F.lit(2.0))
    return t("lineitem").select("l_orderkey", "l_linenumber", P.tidy(mixed, 9).alias("mixed"))


@query(
    "b20_regex",
    "SELECT c_custkey, regexp_extract(c_name, '#(0*)([0-9]+)$', 2) AS digits, regexp_replace(c_name, '^Customer#', 'c_') AS short FROM customer",
)
def _(t):
    return t("customer").select(
        "c_custkey",
        F.regexp_extract("c_name", "#(0*)([0-9]+)$", 2).alias("digits"),
        F.regexp_replace("c_name", "^Customer#", "c_").alias("short"),
    )


@query("b21_text_length", "SELECT doc_id, CAST(length(text) AS INT) AS n, length(trim(source)) > 0 AS filled FROM documents")
def _(t):
    return t("documents").select("doc_id", F.length("text").alias("n"), (F.length(F.trim("source")) > 0).alias("filled"))


@query("g11_equi_join", "SELECT o_orderkey, n_lines, o_orderpriority FROM orders JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_lines FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey")
def _(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    return t("orders").join(lines, ["o_orderkey"], "inner").select("o_orderkey", "n_lines", "o_orderpriority")


@query(
    "g13_vertical_concat",
    "SELECT 'order' AS kind, o_orderkey AS key FROM orders UNION ALL SELECT 'event', event_id FROM events",
)
def _(t):
    orders = t("orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("key"))
    return orders.unionByName(t("events").select(F.lit("event").alias("kind"), F.col("event_id").alias("key")))


@query(
    "g14_first_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) = 1",
)
def _(t):
    order = W.partitionBy("o_custkey").orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey")
    first = t("orders").withColumn("place", F.row_number().over(order)).where(F.col("place") == 1)
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "g16_category_union",
    """SELECT coalesce(a.k, b.k) AS category, coalesce(a.n, 0) AS n_customers, coalesce(b.n, 0) AS n_suppliers FROM
    (SELECT c_nationkey % 20 AS k, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1) a FULL JOIN
    (SELECT s_nationkey AS k, CAST(count(*) AS BIGINT) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""",
)
def _(t):
    left = t("customer").groupBy((F.col("c_nationkey") % 20).alias("category")).agg(F.count(F.lit(1)).alias("n_customers"))
    right = t("supplier").groupBy(F.col("s_nationkey").alias("category")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    both = left.join(right, "category", "full")
    return both.select("category", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_customers", "n_suppliers")])
