"""Preprocessing queries: numbers fitted on 1995-1997 orders, applied to all."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.functions import tidy
from plumbline.operators import preprocess as P
from plumbline.plans.catalogue import query
from plumbline.plans.views import CATEGORICAL, NUMERIC, ORDERS_WIDE, orders_wide, rnd
from plumbline.session import stage

TRAIN_UNTIL = 1997
PRIORITY_SQL = "CASE WHEN row_id % 10 < 2 THEN NULL ELSE priority END"


def holed(t):
    """Orders whose priority is missing for every key ending in 0 or 1."""
    rows = stage(orders_wide(t), "orders_wide")  # the fit reads the join several times
    return rows.withColumn("priority", F.when(F.col("row_id") % 10 >= 2, F.col("priority")))


def fitted(t, numeric=NUMERIC, categorical=CATEGORICAL):
    rows = holed(t)
    # Orders of one market stay out of the fit, so its level is unseen later.
    train = rows.where((F.col("yr") <= TRAIN_UNTIL) & (F.col("segment") != "MACHINERY"))
    return rows, P.fit_preprocessor(train, numeric, categorical, digits=9)


HOLED = f"""{ORDERS_WIDE}, holed AS (SELECT * REPLACE ({PRIORITY_SQL} AS priority) FROM orders_wide),
train AS (SELECT * FROM holed WHERE yr <= {TRAIN_UNTIL} AND segment <> 'MACHINERY')"""
MEDIANS = "med AS (SELECT " + ", ".join(f"round(quantile_cont({c}, 0.5), 9) AS med_{c}" for c in NUMERIC) + " FROM train)"
STATS = "stat AS (SELECT " + ", ".join(
    f"avg(coalesce({c}, med_{c})) AS mean_{c}, stddev_pop(coalesce({c}, med_{c})) AS sd_{c}" for c in NUMERIC
) + " FROM train, med)"
MODES = "mode_of AS (SELECT " + ", ".join(
    f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode_{c}" for c in CATEGORICAL
) + ")"
FITTED = f"{HOLED}, {MEDIANS}, {STATS}, {MODES}"


@query(
    "c01_median_imputation",
    f"WITH {HOLED}, {MEDIANS} SELECT row_id, " + ", ".join(f"{rnd(f'coalesce({c}, med_{c})')} AS {c}" for c in NUMERIC) + " FROM holed, med",
)
def _(t):
    rows, fit = fitted(t, categorical=())
    return fit.imputed(rows).select("row_id", *[tidy(F.col(c)).alias(c) for c in NUMERIC])


@query(
    "c02_most_frequent_imputation",
    f"WITH {HOLED}, {MODES} SELECT row_id, " + ", ".join(f"coalesce({c}, mode_{c}) AS {c}" for c in CATEGORICAL) + " FROM holed, mode_of",
)
def _(t):
    rows, fit = fitted(t, numeric=())
    return fit.imputed(rows).select("row_id", *CATEGORICAL)


SCALED = ", ".join(f"{rnd(f'(coalesce({c}, med_{c}) - mean_{c}) / sd_{c}')} AS num__{c}" for c in NUMERIC)


@query("c03_standard_scaling", f"WITH {FITTED} SELECT row_id, {SCALED} FROM holed, med, stat")
def _(t):
    rows, fit = fitted(t, categorical=())
    return fit.scaled(rows).select("row_id", *[tidy(F.col(f"num__{c}")).alias(f"num__{c}") for c in NUMERIC])


LEVELS = "level AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS v FROM train WHERE {c} IS NOT NULL" for c in CATEGORICAL) + ")"
HOT = " UNION ALL ".join(
    f"SELECT 'cat__{c}_' || v AS name, coalesce({c}, mode_{c}) = v AS hot FROM holed, mode_of, level WHERE feature = '{c}'"
    for c in CATEGORICAL
)


@query(
    "c04_one_hot",
    f"""WITH {HOLED}, {MODES}, {LEVELS} SELECT name, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE hot) AS BIGINT) AS n_hot
    FROM ({HOT}) GROUP BY name""",
)
def _(t):
    rows, fit = fitted(t, numeric=())
    cells = fit.vectors(rows).select(vector_to_array("features").alias("v"))
    labels = F.array(*[F.lit(n) for n in fit.names])
    return (
        cells.select(F.posexplode("v").alias("i", "x"))
        .groupBy("i")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == 1.0).alias("n_hot"))
        .select(F.get(labels, F.col("i")).alias("name"), "n", "n_hot")
    )


@query(
    "c05_transformer_names",
    f"""WITH {HOLED}, {LEVELS}, names AS (SELECT 0 AS part, i AS feature_no, '' AS v, name FROM (VALUES
      {', '.join(f"({i}, 'num__{c}')" for i, c in enumerate(NUMERIC))}) x(i, name)
      UNION ALL SELECT 1, CASE feature WHEN 'priority' THEN 0 ELSE 1 END, v, 'cat__' || feature || '_' || v FROM level)
    SELECT CAST(row_number() OVER (ORDER BY part, feature_no, v) - 1 AS BIGINT) AS position, name FROM names""",
)
def _(t):
    _rows, fit = fitted(t)
    rows = list(enumerate(fit.names))
    return t.spark.createDataFrame(rows, "position bigint, name string")


ALL_FLAGS = " + ".join(f"CAST(coalesce({c}, mode_{c}) IN (SELECT v FROM level WHERE feature = '{c}') AS INT)" for c in CATEGORICAL)


@query(
    "c06_fit_transform",
    f"""WITH {FITTED}, {LEVELS} SELECT row_id, CASE WHEN yr <= {TRAIN_UNTIL} THEN 'train' ELSE 'test' END AS split,
    {rnd(' + '.join(f'(coalesce({c}, med_{c}) - mean_{c}) / sd_{c}' for c in NUMERIC) + ' + ' + ALL_FLAGS)} AS vector_sum
    FROM holed, med, stat, mode_of""",
)
def _(t):
    rows, fit = fitted(t)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, x: acc + x)
    split = F.when(F.col("yr") <= TRAIN_UNTIL, F.lit("train")).otherwise(F.lit("test"))
    return fit.vectors(rows).select("row_id", split.alias("split"), tidy(total).alias("vector_sum"))


PICKED = ["num__quantity", "cat__segment_BUILDING", "num__total_k"]


def picked_sql(*extra: str) -> str:
    def scaled(c):
        return rnd(f"(coalesce({c}, med_{c}) - mean_{c}) / sd_{c}")

    return f"""WITH {FITTED} SELECT row_id, {scaled('quantity')} AS num__quantity,
    CAST(coalesce(segment, mode_segment) = 'BUILDING' AS DOUBLE) AS cat__segment_BUILDING, {scaled('total_k')} AS num__total_k
    {''.join(', ' + e for e in extra)} FROM holed, med, stat, mode_of"""


@query("c07_select_by_name", picked_sql())
def _(t):
    rows, fit = fitted(t)
    cells = vector_to_array("features")
    sliced = fit.vectors(rows, [*PICKED, "num__unknown"])
    return sliced.select("row_id", *[tidy(cells[i]).alias(n) for i, n in enumerate(PICKED)])


@query("c08_select_with_zero_fill", picked_sql("CAST(0 AS DOUBLE) AS num__unknown"))
def _(t):
    rows, fit = fitted(t)
    wanted = [*PICKED, "num__unknown"]
    return fit.columns(rows, wanted).select("row_id", *[tidy(F.col(c)).alias(c) for c in wanted])
