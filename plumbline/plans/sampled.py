"""Split, fold, sample and window queries; every draw is decided by md5."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import tidy
from plumbline.operators import sampling as P
from plumbline.plans.catalogue import query
from plumbline.plans.views import num, rnd

LABELLED = """labelled AS (
  SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INT) AS y, o_totalprice AS total,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust, o_orderpriority AS priority,
         CAST(year(o_orderdate) AS INT) AS window_id FROM orders)"""


def labelled(t):
    return t("orders").select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.col("o_totalprice").alias("total"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey").cast("double")).alias("cust"),
        F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("window_id"),
    )


def md5(seed, key: str = "row_id") -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{seed}')"


def ranks(strata: str, seed=42, source: str = "labelled") -> str:
    by = f"PARTITION BY {strata} " if strata else ""
    return f"""ranks AS (SELECT *, row_number() OVER ({by}ORDER BY {md5(seed)}) AS r, count(*) OVER ({by}) AS n FROM {source})"""


def quota(n: str, share: float) -> str:
    return f"floor(CAST({n} AS DOUBLE) * {num(share)} + {num(0.5)})"


@query(
    "d01_stratified_split",
    f"""WITH {LABELLED}, {ranks('y')} SELECT row_id, y, CASE WHEN r <= {quota('n', 0.2)} THEN 'test' ELSE 'train' END AS split FROM ranks""",
)
def _(t):
    return P.split_two(labelled(t), "row_id").select("row_id", "y", "split")


@query(
    "d02_three_way_split",
    f"""WITH {LABELLED}, {ranks('y')}, q AS (SELECT *, {quota('n', 0.2)} AS q_test FROM ranks),
    v AS (SELECT *, {quota('n - q_test', 0.2 / (1.0 - 0.2))} AS q_valid FROM q)
    SELECT row_id, y, CASE WHEN r <= q_test THEN 'test' WHEN r <= q_test + q_valid THEN 'validation' ELSE 'train' END AS split FROM v""",
)
def _(t):
    return P.split_three(labelled(t), "row_id").select("row_id", "y", "split")


@query("d03_stratified_folds", f"WITH {LABELLED}, {ranks('y')} SELECT row_id, y, CAST((r - 1) % 5 AS INT) AS fold FROM ranks")
def _(t):
    return P.folds(labelled(t), "row_id").select("row_id", "y", "fold")


@query(
    "d04_reference_split",
    f"""WITH {LABELLED}, {ranks('y')} SELECT y, CASE WHEN r <= {quota('n', 0.35)} THEN 'reference' ELSE 'train' END AS split,
    CAST(count(*) AS BIGINT) AS n, CAST(sum(row_id) AS BIGINT) AS key_sum FROM ranks GROUP BY ALL""",
)
def _(t):
    rows = P.split_two(labelled(t), "row_id", test_share=0.35, names=("train", "reference"))
    return rows.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("key_sum"))


@query(
    "d05_window_split",
    f"""WITH {LABELLED}, {ranks('window_id, y')} SELECT window_id, row_id, CASE WHEN r <= {quota('n', 0.4)} THEN 'test' ELSE 'train' END AS split FROM ranks""",
)
def _(t):
    rows = P.split_two(labelled(t), "row_id", strata=("window_id", "y"), test_share=0.4)
    return rows.select("window_id", "row_id", "split")


@query(
    "d06_fixed_size_sample",
    f"""WITH {LABELLED}, {ranks('window_id, y')},
    slots AS (SELECT window_id, y, i, 1 + CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % n AS r
      FROM (SELECT DISTINCT window_id, y, n FROM ranks WHERE n < 300), range(1, 301) g(i))
    SELECT window_id, y, row_id, CAST(r AS BIGINT) AS draw_no FROM ranks WHERE n >= 300 AND r <= 300
    UNION ALL SELECT s.window_id, s.y, row_id, CAST(i AS BIGINT) FROM slots s JOIN ranks k ON s.window_id = k.window_id AND s.y = k.y AND s.r = k.r""",
)
def _(t):
    return P.draw(labelled(t), "row_id", 300, ("window_id", "y")).select("window_id", "y", "row_id", "draw_no")


PRIOR = f"""pos AS (SELECT *, row_number() OVER (ORDER BY {md5('42+')}) AS draw_no FROM labelled WHERE y = 1),
neg AS (SELECT *, row_number() OVER (ORDER BY {md5('42-')}) AS draw_no FROM labelled WHERE y = 0),
prior AS (SELECT * FROM pos WHERE draw_no <= 300 UNION ALL
  SELECT * REPLACE (draw_no + 300 AS draw_no) FROM neg WHERE draw_no <= 100)"""


@query("d07_prior_shift", f"WITH {LABELLED}, {PRIOR} SELECT row_id, y, CAST(draw_no AS BIGINT) AS draw_no FROM prior")
def _(t):
    return P.prior_shift(labelled(t), "row_id", 400).select("row_id", "y", "draw_no")


def shifted(source: str, seed: str, key: str) -> str:
    uniform = f"(CAST('0x' || substr({md5(seed, key)}, 1, 8) AS BIGINT) + {num(0.5)}) / {num(4294967296.0)}"
    return f"""SELECT s.* REPLACE (total + {num(0.8)} * sd_total AS total, coalesce(cust, med_cust) + {num(0.8)} * sd_cust AS cust,
      CASE WHEN {uniform} < {num(0.4)} THEN last ELSE priority END AS priority)
    FROM {source} s, (SELECT stddev_samp(total) AS sd_total, stddev_samp(cust) AS sd_cust,
      round(quantile_cont(cust, 0.5), 9) AS med_cust, max(priority) AS last FROM {source})"""


NUMBERS = ["total", "cust"]


@query(
    "d08_covariate_shift",
    f"""WITH {LABELLED} SELECT row_id, {rnd('total', 4)} AS total, {rnd('cust', 4)} AS cust, priority FROM ({shifted('labelled', '42', 'row_id')})""",
)
def _(t):
    rows = P.covariate_shift(labelled(t), "row_id", NUMBERS, ["priority"])
    return rows.select("row_id", *[tidy(F.col(c), 4).alias(c) for c in NUMBERS], "priority")


@query(
    "d09_monitoring_windows",
    f"""WITH {LABELLED}, stable AS (SELECT *, row_number() OVER (ORDER BY {md5(42)}) AS draw_no FROM labelled QUALIFY draw_no <= 400),
    {PRIOR}, w AS (SELECT 1 AS w, 'stable' AS scenario, * FROM stable UNION ALL SELECT 2, 'covariate', * FROM ({shifted('stable', '42|2', 'draw_no')})
      UNION ALL SELECT 3, 'prior', * FROM prior UNION ALL SELECT 4, 'combined', * FROM ({shifted('prior', '42|4', 'draw_no')}))
    SELECT CAST(w AS INT) AS window_id, scenario, row_id, y, CAST(draw_no AS BIGINT) AS draw_no, {rnd('total', 4)} AS total, {rnd('cust', 4)} AS cust, priority FROM w""",
)
def _(t):
    rows = P.monitoring_windows(labelled(t).drop("window_id"), "row_id", NUMBERS, ["priority"], size=400)
    numbers = [tidy(F.col(c), 4).alias(c) for c in NUMBERS]
    return rows.select("window_id", "scenario", "row_id", "y", "draw_no", *numbers, "priority")


@query(
    "d09_time_windows",
    """SELECT 'w' || strftime(date_trunc('day', ts), '%Y%m%d%H%M') AS scenario, CAST(count(*) AS BIGINT) AS n,
    CAST(epoch(date_trunc('day', min(ts))) AS BIGINT) AS window_id FROM events GROUP BY scenario""",
)
def _(t):
    rows = P.time_windows(t("events"), "ts", "1 day")
    return rows.groupBy("scenario", "window_id").agg(F.count(F.lit(1)).alias("n"))
