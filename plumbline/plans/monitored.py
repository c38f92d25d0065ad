"""Drift, quality and retraining queries over yearly windows of lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.functions import tidy
from plumbline.operators import drift as D
from plumbline.operators import retrain as R
from plumbline.operators import states as S
from plumbline.plans.catalogue import query
from plumbline.plans.measured import RECORD, record_sql, tidy_sql
from plumbline.plans.views import (
    LINE_CATEGORICAL,
    LINE_NUMERIC,
    REFERENCE_YEAR,
    line_reference,
    line_windows,
    num,
    rnd,
    scored,
)
from plumbline.session import partitions_for, scratch_folder

PROBS = [k / 10 for k in range(11)]


def psi_term(r: str, c: str) -> str:
    a, b = f"greatest({r}, {num(C.PSI_FLOOR)})", f"greatest({c}, {num(C.PSI_FLOOR)})"
    return f"({b} - {a}) * ln({b} / {a})"


def numeric_sql(source: str, features, key: str = "window_id", ref: str = str(REFERENCE_YEAR)) -> str:
    """CTEs ks and psi per (window_id, feature) of a long numeric table.

    `source` is SQL for rows (window_id, features...); the reference has key `ref`.
    """
    cells = " UNION ALL ".join(
        f"SELECT window_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM rows_in WHERE {f} IS NOT NULL"
        for f in features
    )
    quantiles = ", ".join(f"round(quantile_cont(value, {num(p)}), 9)" for p in PROBS)
    return f"""rows_in AS ({source}),
cells AS ({cells}),
edge_list AS (SELECT feature, list_sort(list_distinct([{quantiles}])) AS e FROM cells WHERE window_id = {ref} GROUP BY feature),
counts AS (SELECT window_id, feature, value, count(*) AS n FROM cells GROUP BY ALL),
psi_binned AS (
  SELECT window_id, feature, least((SELECT count(*) FROM (SELECT unnest(e) AS edge) WHERE edge <= value) - 1, len(e) - 2) AS bin,
         sum(n) AS n
  FROM counts JOIN edge_list USING (feature) WHERE value BETWEEN e[1] AND e[len(e)] GROUP BY ALL),
shares AS (SELECT window_id, feature, bin, n / sum(n) OVER (PARTITION BY window_id, feature) AS share FROM psi_binned),
windows AS (SELECT DISTINCT window_id, feature FROM cells WHERE window_id <> {ref}),
grid AS (SELECT windows.window_id, feature, bin FROM windows JOIN edge_list USING (feature), range(0, 10) g(bin) WHERE bin < len(e) - 1),
psi AS (
  SELECT grid.window_id, grid.feature, sum({psi_term('coalesce(r.share, 0)', 'coalesce(c.share, 0)')}) AS psi
  FROM grid LEFT JOIN shares r ON r.window_id = {ref} AND r.feature = grid.feature AND r.bin = grid.bin
  LEFT JOIN shares c ON c.window_id = grid.window_id AND c.feature = grid.feature AND c.bin = grid.bin
  GROUP BY ALL),
steps AS (
  SELECT w.window_id, w.feature, value, sum(n * CAST(c.window_id = {ref} AS INT)) AS r,
         sum(n * CAST(c.window_id = w.window_id AS INT)) AS c
  FROM windows w JOIN counts c ON c.feature = w.feature AND c.window_id IN ({ref}, w.window_id) GROUP BY ALL),
climb AS (
  SELECT window_id, feature, sum(r) OVER w AS r_upto, sum(c) OVER w AS c_upto,
         sum(r) OVER (PARTITION BY window_id, feature) AS n_ref, sum(c) OVER (PARTITION BY window_id, feature) AS n_cur
  FROM steps WINDOW w AS (PARTITION BY window_id, feature ORDER BY value)),
ks AS (
  SELECT window_id, feature, CAST(max(n_ref) AS DOUBLE) AS n_ref, CAST(max(n_cur) AS DOUBLE) AS n_cur,
         max(abs(CAST(r_upto AS DOUBLE) / n_ref - CAST(c_upto AS DOUBLE) / n_cur)) AS ks
  FROM climb GROUP BY ALL),
ks_p AS (
  SELECT window_id, feature, ks, CASE WHEN x2 < {num(0.04)} THEN 1 ELSE least(greatest(2 * (
    SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * x2)) FROM range(1, 101) g(k)), 0), 1) END AS p_value
  FROM (SELECT *, ks * ks * (n_ref * n_cur / (n_ref + n_cur)) AS x2 FROM ks))"""


LINES = f"""SELECT CAST(year(l_shipdate) AS INT) AS window_id, * FROM lineitem WHERE year(l_shipdate) >= {REFERENCE_YEAR}"""


def chi2_sql(source: str, features, ref: str = str(REFERENCE_YEAR)) -> str:
    """CTE chi per (window_id, feature): statistic, df, p_value, psi."""
    cells = " UNION ALL ".join(
        f"SELECT window_id, '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), 'missing') AS level FROM cat_rows"
        for f in features
    )
    return f"""cat_rows AS ({source}),
levels AS (SELECT window_id, feature, level, count(*) AS n FROM ({cells}) GROUP BY ALL),
cat_windows AS (SELECT DISTINCT window_id, feature FROM levels WHERE window_id <> {ref}),
pairs AS (
  SELECT w.window_id, w.feature, level, CAST(sum(n * CAST(l.window_id = {ref} AS INT)) AS DOUBLE) AS r,
         CAST(sum(n * CAST(l.window_id = w.window_id AS INT)) AS DOUBLE) AS c
  FROM cat_windows w JOIN levels l ON l.feature = w.feature AND l.window_id IN ({ref}, w.window_id) GROUP BY ALL),
sized AS (SELECT *, sum(r) OVER w AS nr, sum(c) OVER w AS nc, count(*) OVER w AS k FROM pairs
  WINDOW w AS (PARTITION BY window_id, feature)),
parts AS (
  SELECT *, (r + c) * nr / (nr + nc) AS er, (r + c) * nc / (nr + nc) AS ec, CASE WHEN k = 2 THEN 0.5 ELSE 0 END AS fix FROM sized),
chi_stat AS (
  SELECT window_id, feature, CAST(max(k) - 1 AS BIGINT) AS df,
    sum(power(abs(r - er) - least(fix, abs(r - er)), 2) / er + power(abs(c - ec) - least(fix, abs(c - ec)), 2) / ec) AS statistic,
    sum({psi_term('r / nr', 'c / nc')}) AS psi
  FROM parts GROUP BY ALL),
chi AS (
  SELECT *, CASE WHEN df <= 0 OR statistic <= 0 THEN 1 WHEN df % 2 = 0 THEN least(1, (
    SELECT sum(exp(n * ln(statistic / 2) - statistic / 2 - lgamma(n + 1))) FROM range(0, CAST(df / 2 AS BIGINT)) g(n)))
    ELSE greatest(1 - (
    SELECT sum(exp((df / 2 + n) * ln(statistic / 2) - statistic / 2 - lgamma(df / 2 + n + 1)))
    FROM range(0, CAST(200 + statistic + 20 * sqrt(statistic) AS BIGINT)) g(n)), 0) END AS p_value
  FROM chi_stat)"""


def cycle_tables(t):
    return line_reference(t), line_windows(t)


def profiled(reference, windows, numeric):
    """Edges at nine digits, as in the SQL."""
    return D.fit_reference(reference, numeric, windows, digits=9)


@query(
    "k01_psi_numeric",
    f"WITH {numeric_sql(LINES, LINE_NUMERIC)} SELECT window_id, feature, {rnd('psi')} AS psi FROM psi",
)
def _(t):
    reference, windows = cycle_tables(t)
    profile = profiled(reference, windows, LINE_NUMERIC)
    table = D.numeric_drift(reference, windows, profile)
    return table.select("window_id", "feature", tidy(F.col("psi")).alias("psi"))


@query(
    "k02_psi_categorical",
    f"WITH {chi2_sql(LINES, LINE_CATEGORICAL)} SELECT window_id, feature, {rnd('psi')} AS psi FROM chi",
)
def _(t):
    reference, windows = cycle_tables(t)
    table = D.categorical_drift(reference, windows, LINE_CATEGORICAL)
    return table.select("window_id", "feature", tidy(F.col("psi")).alias("psi"))


@query(
    "k03_two_sample_ks",
    f"""WITH {numeric_sql(LINES, LINE_NUMERIC)}
    SELECT window_id, feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, {rnd('ks')} AS ks FROM ks""",
)
def _(t):
    reference, windows = cycle_tables(t)
    profile = profiled(reference, windows, LINE_NUMERIC)
    table = D.numeric_drift(reference, windows, profile)
    return table.select("window_id", "feature", "n_ref", "n_cur", tidy(F.col("ks")).alias("ks"))


def audit(t):
    reference, windows = cycle_tables(t)
    profile = profiled(reference, windows, LINE_NUMERIC)
    return D.drift_audit(reference, windows, LINE_NUMERIC, LINE_CATEGORICAL, dataset="lines", profile=profile)


@query(
    "k04_ks_p_value",
    f"WITH {numeric_sql(LINES, LINE_NUMERIC)} SELECT window_id, feature, {rnd('p_value')} AS p_value FROM ks_p",
)
def _(t):
    reference, windows = cycle_tables(t)
    table = D.drift_audit(reference, windows, LINE_NUMERIC)
    return table.select("window_id", "feature", tidy(F.col("p_value")).alias("p_value"))


EVENTS = """SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS window_id, event_type,
  CASE WHEN user_id % 7 = 0 THEN NULL WHEN value > 20 THEN 'high' ELSE 'low' END AS band, value FROM events"""


def daily_events(t):
    """Events by day of January 2024, with a two-level band that may be null."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    band = F.when(F.col("user_id") % 7 != 0, F.when(F.col("value") > 20, F.lit("high")).otherwise(F.lit("low")))
    rows = t("events").select(day.alias("window_id"), "event_type", band.alias("band"), "value")
    windows = rows.where(F.col("window_id") > 0)
    scenario = F.concat(F.lit("d"), F.col("window_id").cast("string"))
    return rows.where(F.col("window_id") == 0), windows.withColumn("scenario", scenario)


@query(
    "k05_chi2_homogeneity",
    f"""WITH {chi2_sql(LINES, LINE_CATEGORICAL)} SELECT window_id, feature, df, {rnd('statistic')} AS statistic FROM chi""",
)
def _(t):
    reference, windows = cycle_tables(t)
    table = D.categorical_drift(reference, windows, LINE_CATEGORICAL)
    return table.select("window_id", "feature", "df", tidy(F.col("chi2")).alias("statistic"))


@query(
    "k06_chi2_p_value",
    f"""WITH {chi2_sql(EVENTS, ['event_type', 'band'], '0')} SELECT window_id, feature, {rnd('p_value')} AS p_value FROM chi""",
)
def _(t):
    reference, windows = daily_events(t)
    table = D.drift_audit(reference, windows, [], ["event_type", "band"])
    return table.select("window_id", "feature", tidy(F.col("p_value")).alias("p_value"))


USERS = """SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) % 4 AS window_id, user_id FROM events"""


@query(
    "k05_high_cardinality",
    f"""WITH {chi2_sql(USERS, ['user_id'], '0')}
    SELECT window_id, feature, df, {rnd('statistic', 4)} AS statistic, {rnd('p_value')} AS p_value, {rnd('psi')} AS psi FROM chi""",
)
def _(t):
    """Every user is a level: every fourth day against the first of the four."""
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) % 4
    rows = t("events").select(day.alias("window_id"), F.lit("day").alias("scenario"), "user_id")
    table = D.categorical_drift(rows.where(F.col("window_id") == 0), rows.where(F.col("window_id") > 0), ["user_id"])
    table = table.withColumn("p_value", D.chi2_upper_tail("chi2", "df"))
    return table.select("window_id", "feature", "df", tidy(F.col("chi2"), 4).alias("statistic"), tidy(F.col("p_value")).alias("p_value"), tidy(F.col("psi")).alias("psi"))


AUDIT_SQL = f"""{numeric_sql(LINES, LINE_NUMERIC)}, {chi2_sql(LINES, LINE_CATEGORICAL)},
audit AS (
  SELECT 'lines' AS dataset, window_id, 'y' || CAST(window_id AS VARCHAR) AS scenario, feature, 'numeric' AS feature_type,
         'ks' AS detector, ks AS statistic, p_value, psi AS effect_size FROM ks_p JOIN psi USING (window_id, feature)
  UNION ALL
  SELECT 'lines', window_id, 'y' || CAST(window_id AS VARCHAR), feature, 'categorical', 'chi2', statistic, p_value, psi FROM chi),
flagged AS (SELECT *, p_value < {num(C.ALPHA)} OR effect_size >= {num(C.PSI_ALERT)} AS drift_flag FROM audit)"""


@query(
    "k07_drift_flag",
    f"""WITH {AUDIT_SQL} SELECT window_id, feature, drift_flag, CASE WHEN effect_size >= {num(0.25)} THEN 'alert'
    WHEN effect_size >= {num(0.1)} THEN 'warn' ELSE 'stable' END AS severity FROM flagged""",
)
def _(t):
    return audit(t).select("window_id", "feature", "drift_flag", D.drift_severity(F.col("effect_size")).alias("severity"))


STATS = ("statistic", "p_value", "effect_size")


def drift_audit_query(t):
    """Flagship: every year against 1995, every feature, one audit table."""
    table = audit(t)
    return table.select(*[tidy(F.col(c)).alias(c) if c in STATS else F.col(c) for c in C.DRIFT_COLUMNS])


query(
    "k08_drift_audit",
    f"""WITH {AUDIT_SQL} SELECT dataset, window_id, scenario, feature, feature_type, detector, {tidy_sql(STATS)}, drift_flag FROM flagged""",
)(drift_audit_query)


@query(
    "k08_drift_audit_events",
    f"""WITH {numeric_sql(EVENTS, ['value'], ref='0')}, {chi2_sql(EVENTS, ['event_type', 'band'], '0')}
    SELECT window_id, feature, {rnd('ks')} AS statistic, {rnd('p_value')} AS p_value, {rnd('psi')} AS effect_size
    FROM ks_p JOIN psi USING (window_id, feature)
    UNION ALL SELECT window_id, feature, {rnd('statistic')}, {rnd('p_value')}, {rnd('psi')} FROM chi""",
)
def _(t):
    reference, windows = daily_events(t)
    profile = profiled(reference, windows, ["value"])
    table = D.drift_audit(reference, windows, ["value"], ["event_type", "band"], profile=profile)
    return table.select("window_id", "feature", *[tidy(F.col(c)).alias(c) for c in STATS])


def monthly_states(t):
    """States of the lines per month, written in two runs as a scheduled job would."""
    lines = t("lineitem")
    path = scratch_folder(lines.sparkSession, "line-states")
    partitions = partitions_for(lines.sparkSession, lines.count())
    later = F.col("l_shipdate") >= F.lit("1998-01-01").cast("date")
    for part in (~later, later):
        month = F.trunc("l_shipdate", "month")
        S.write_states(S.period_states(lines.where(part), month, LINE_NUMERIC, LINE_CATEGORICAL), path, partitions)
    return S.read_states(lines.sparkSession, path)


def state_audit(states, windows):
    """Windows of (window_id, period) against the months of the reference year."""
    year = F.year("period")
    reference = states.select("period").distinct().where(year == REFERENCE_YEAR)
    windows = windows.withColumn("scenario", F.concat(F.lit("y"), F.col("window_id").cast("string")))
    return S.drift_audit_of_states(states, reference, windows, dataset="lines", digits=9)


@query(
    "k08_audit_from_states",
    f"""WITH {AUDIT_SQL} SELECT dataset, window_id, scenario, feature, feature_type, detector, {tidy_sql(STATS)}, drift_flag FROM flagged""",
)
def _(t):
    """The flagship audit again, from counted states of months instead of rows."""
    states = monthly_states(t)
    months = states.select("period").distinct().where(F.year("period") > REFERENCE_YEAR)
    table = state_audit(states, months.select(F.year("period").alias("window_id"), "period"))
    return table.select(*[tidy(F.col(c)).alias(c) if c in STATS else F.col(c) for c in C.DRIFT_COLUMNS])


HALF = "CAST(2 * year({d}) + CASE WHEN month({d}) > 6 THEN 1 ELSE 0 END AS INT)"
ROLLING = f"""SELECT CAST(0 AS INT) AS window_id, * FROM lineitem WHERE year(l_shipdate) = {REFERENCE_YEAR}
  UNION ALL SELECT {HALF.format(d='l_shipdate')} + CAST(g.k AS INT), l.* FROM lineitem l, range(0, 2) g(k)
  WHERE {HALF.format(d='l_shipdate')} + g.k >= {2 * REFERENCE_YEAR + 2}"""


@query(
    "k08_rolling_audit",
    f"""WITH {numeric_sql(ROLLING, LINE_NUMERIC, ref='0')}, {chi2_sql(ROLLING, LINE_CATEGORICAL, '0')}
    SELECT window_id, feature, {rnd('ks')} AS statistic, {rnd('p_value')} AS p_value, {rnd('psi')} AS effect_size
    FROM ks_p JOIN psi USING (window_id, feature)
    UNION ALL SELECT window_id, feature, {rnd('statistic')}, {rnd('p_value')}, {rnd('psi')} FROM chi""",
)
def _(t):
    """Trailing years that end with every half-year: windows overlap, states are counted once."""
    states = monthly_states(t)
    half = F.expr(HALF.format(d="period"))
    months = states.select("period").distinct()
    windows = months.select("period", F.explode(F.array(half, half + 1)).alias("window_id"))
    table = state_audit(states, windows.where(F.col("window_id") >= 2 * REFERENCE_YEAR + 2))
    return table.select("window_id", "feature", *[tidy(F.col(c)).alias(c) for c in STATS])


# Quality: the fixed score, its three variants as models, 1995 as the baseline.
QUALITY_SQL = f"""{record_sql('window_id, variant', 'window_id, variant')},
base AS (SELECT variant, f1 AS base_f1, expected_cost AS base_cost FROM record WHERE window_id = {REFERENCE_YEAR}),
quality AS (
  SELECT 'lines' AS dataset, window_id, 'y' || CAST(window_id AS VARCHAR) AS scenario, variant AS model_variant,
    accuracy, f1, roc_auc, pr_auc, brier, ece, expected_cost,
    f1 - base_f1 AS delta_f1_vs_reference, expected_cost - base_cost AS delta_cost_vs_reference
  FROM record JOIN base USING (variant) WHERE window_id > {REFERENCE_YEAR})"""


def quality(t):
    rows = scored(t).withColumns(
        {
            "dataset": F.lit("lines"),
            "scenario": F.concat(F.lit("y"), F.col("window_id").cast("string")),
            "model_variant": F.col("variant"),
        }
    )
    baseline = R.reference_metrics(rows.where(F.col("window_id") == REFERENCE_YEAR))
    return R.quality_audit(rows.where(F.col("window_id") > REFERENCE_YEAR), baseline)


QUALITY_NUMBERS = (*RECORD, "delta_f1_vs_reference", "delta_cost_vs_reference")


@query(
    "k09_quality_audit",
    f"""WITH {QUALITY_SQL} SELECT dataset, window_id, scenario, model_variant, {tidy_sql(QUALITY_NUMBERS)} FROM quality""",
)
def _(t):
    return quality(t).select(*C.QUALITY_COLUMNS[:4], *[tidy(F.col(c)).alias(c) for c in QUALITY_NUMBERS])


SHARE_SQL = f"""{AUDIT_SQL}, share AS (
  SELECT dataset, window_id, scenario, avg(CAST(drift_flag AS INT)) AS drift_feature_share FROM flagged GROUP BY ALL)"""


@query(
    "k10_drift_share",
    f"WITH {SHARE_SQL} SELECT dataset, window_id, scenario, {rnd('drift_feature_share')} AS drift_feature_share FROM share",
)
def _(t):
    return R.drift_share(audit(t)).select(*R.WINDOW_KEYS, tidy(F.col("drift_feature_share")).alias("drift_feature_share"))


WORST_SQL = f"""{QUALITY_SQL}, worst AS (
  SELECT dataset, window_id, scenario, min(delta_f1_vs_reference) AS delta_f1_vs_reference,
         max(delta_cost_vs_reference) AS delta_cost_vs_reference FROM quality GROUP BY ALL)"""
DELTAS = ("delta_f1_vs_reference", "delta_cost_vs_reference")


@query("k11_worst_case", f"WITH {WORST_SQL} SELECT dataset, window_id, scenario, {tidy_sql(DELTAS)} FROM worst")
def _(t):
    return R.worst_case(quality(t)).select(*R.WINDOW_KEYS, *[tidy(F.col(c)).alias(c) for c in DELTAS])


def action_sql(share: float, drop: float, increase: float) -> str:
    reason = f"""concat_ws(';', CASE WHEN drift_feature_share >= {num(share)} THEN 'drift_share' END,
      CASE WHEN delta_f1_vs_reference <= {num(-drop)} THEN 'f1_drop' END,
      CASE WHEN delta_cost_vs_reference >= {num(increase)} THEN 'cost_increase' END)"""
    return f"""CASE WHEN {reason} = '' THEN 'observe' ELSE 'retrain' END AS policy_action,
      CASE WHEN {reason} = '' THEN 'no_trigger' ELSE {reason} END AS trigger_reason"""


@query(
    "k12_retrain_rule",
    f"""WITH {WORST_SQL}, s AS (SELECT window_id, model_variant, (window_id % 10) / CAST(20 AS DOUBLE) AS drift_feature_share,
      delta_f1_vs_reference, delta_cost_vs_reference FROM quality)
    SELECT window_id, model_variant, {action_sql(0.3, 0.01, 0.01)} FROM s""",
)
def _(t):
    signals = quality(t).select(
        "window_id",
        "model_variant",
        ((F.col("window_id") % 10) / F.lit(20.0)).alias("drift_feature_share"),
        *DELTAS,
    )
    return R.with_action(signals, 0.3, 0.01, 0.01).select("window_id", "model_variant", "policy_action", "trigger_reason")


NUMBERS = ("drift_feature_share", *DELTAS)


@query(
    "k13_retraining_decisions",
    f"""WITH {SHARE_SQL}, {WORST_SQL} SELECT dataset, window_id, scenario, {tidy_sql(NUMBERS)}, {action_sql(0.1, 0.01, 0.02)}
    FROM share JOIN worst USING (dataset, window_id, scenario)""",
)
def _(t):
    table = R.retraining_decisions(audit(t), quality(t), share=0.1, f1_drop=0.01, cost_increase=0.02)
    return table.select(*[tidy(F.col(c)).alias(c) if c in NUMBERS else F.col(c) for c in C.DECISION_COLUMNS])


@query(
    "k16_scenario_summary",
    f"""WITH {SHARE_SQL}, {WORST_SQL} SELECT dataset, window_id, scenario, {rnd('drift_feature_share')} AS drift_feature_share,
    {rnd('delta_cost_vs_reference')} AS max_delta_cost_vs_reference FROM share JOIN worst USING (dataset, window_id, scenario)""",
)
def _(t):
    table = R.scenario_summary(audit(t), quality(t))
    names = ("drift_feature_share", "max_delta_cost_vs_reference")
    return table.select(*R.WINDOW_KEYS, *[tidy(F.col(c)).alias(c) for c in names])
