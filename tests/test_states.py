"""Drift audits from mergeable states beside audits of raw rows."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import drift as D, ordered
from plumbline.operators import states as S
from plumbline.session import stage

NUMERIC, CATEGORICAL = ["a", "flat", "late"], ["c", "two"]
ROWS = "a double, flat double, late string, c string, two string, day int"


def day_of():
    return F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))


def sample(spark, n=600, days=6):
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("int")
    day = F.pmod(F.col("id"), F.lit(days)).cast("int")
    return spark.range(n).select(
        F.when(h(1) > 50, F.round(h(2) / 37.0 + day, 2)).alias("a"),
        F.when(h(3) > 500, 2.0).otherwise(5.0).alias("flat"),
        F.when(day > 2, (h(4) % 20).cast("string")).otherwise("n/a").alias("late"),
        F.when(h(5) > 100, F.concat(F.lit("l"), (h(6) % 5 + (day / 3).cast("int")).cast("string"))).alias("c"),
        F.when(h(7) > 300, "p").otherwise("q").alias("two"),
        day.alias("day"),
    )


def calendar(spark, rows):
    """Rows (window_id, first day, last day) as a table of periods."""
    days = spark.createDataFrame(rows, "window_id int, low int, high int")
    days = days.select("window_id", F.explode(F.sequence("low", "high")).alias("day"))
    return days.select("window_id", F.concat(F.lit("s"), F.col("window_id")).alias("scenario"), "day")


def table(df):
    return {
        (r["window_id"], r["feature"]): (r["scenario"], r["feature_type"], r["statistic"], r["p_value"], r["effect_size"], r["drift_flag"])
        for r in df.collect()
    }


def test_overlapping_windows_equal_the_audit_of_rows(spark):
    rows = sample(spark)
    days = calendar(spark, [(1, 2, 3), (2, 3, 5), (3, 0, 5)])
    windows = rows.join(days, "day")
    reference = rows.where("day < 2")
    expected = table(D.drift_audit(reference, windows, NUMERIC, CATEGORICAL))
    states = S.period_states(rows, day_of(), NUMERIC, CATEGORICAL)
    listed = days.select("window_id", "scenario", day_of().alias("period"))
    twice = listed.unionByName(listed)
    first = states.select("period").distinct().where("period < '2024-01-03'")
    found = table(S.drift_audit_of_states(states, first, twice))
    assert set(found) == set(expected) and len(found) == 15
    for key, want in expected.items():
        got = found[key]
        assert got[:2] == want[:2] and got[5] == want[5], key
        assert got[2:5] == pytest.approx(want[2:5], abs=1e-9), key


def test_states_sum_to_the_rows(spark):
    rows = sample(spark)
    totals = {
        r["feature"]: (r["n"], r["nulls"])
        for r in S.period_states(rows, day_of(), NUMERIC, CATEGORICAL)
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("value").isNull() & F.col("level").isNull(), F.col("n"))).alias("nulls"))
        .collect()
    }
    assert {n for n, _ in totals.values()} == {600}
    assert totals["a"][1] == rows.where("a IS NULL").count()
    assert totals["late"][1] == rows.where("day <= 2").count()


def test_a_period_written_again_is_replaced(spark, tmp_path):
    rows, path = sample(spark), str(tmp_path / "states")
    S.write_states(S.period_states(rows.where("day < 3"), day_of(), NUMERIC, CATEGORICAL), path)
    # The next run counts day 2 again and adds the later days.
    S.write_states(S.period_states(rows.where("day >= 2"), day_of(), NUMERIC, CATEGORICAL), path)
    key = lambda r: tuple(str(r[c]) for c in ("period", *S.KEYS, "n"))
    found = sorted(map(key, S.read_states(spark, path).collect()))
    assert found == sorted(map(key, S.period_states(rows, day_of(), NUMERIC, CATEGORICAL).collect()))
    one = S.read_states(spark, path).where(F.col("period") == datetime.date(2024, 1, 3))
    assert len(one.inputFiles()) > 0 and one.agg(F.sum("n")).first()[0] == 100 * 5


def test_states_of_no_rows_and_of_one_kind(spark):
    empty = spark.createDataFrame([], ROWS)
    states = S.period_states(empty, day_of(), NUMERIC, CATEGORICAL)
    assert states.count() == 0
    rows = sample(spark)
    only = S.period_states(rows, day_of(), [], ["two"])
    periods = only.select("period").distinct()
    windows = periods.where("period > '2024-01-03'").select(F.lit(1).alias("window_id"), F.lit("s").alias("scenario"), "period")
    audit = S.drift_audit_of_states(only, periods.where("period <= '2024-01-03'"), windows).collect()
    assert [(r["feature"], r["detector"]) for r in audit] == [("two", "chi2")]


def test_bad_states_raise(spark):
    rows = sample(spark)
    with pytest.raises(ValueError):
        S.period_states(rows, day_of(), [])
    with pytest.raises(ValueError):
        S.period_states(rows, day_of(), ["a"], ["a"])
    with pytest.raises(Exception, match="no period"):
        S.period_states(rows, F.lit(None), ["a"]).collect()


def test_what_a_task_holds_is_bounded(spark, monkeypatch):
    rows = sample(spark)
    windows = calendar(spark, [(1, 2, 3), (2, 3, 5)])
    states = stage(S.period_states(rows, day_of(), NUMERIC, CATEGORICAL), "states")
    listed = windows.select("window_id", "scenario", day_of().alias("period"))
    first = states.select("period").distinct().where("period < '2024-01-03'")
    key = lambda df: {k: (v[:2], [round(x, 9) for x in v[2:5]]) for k, v in table(df).items()}
    expected = key(S.drift_audit_of_states(states, first, listed))
    merged = {}
    monkeypatch.setattr(S, "stage", lambda df, label: merged.update({label: df}) or stage(df, label))
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    audit = S.drift_audit_of_states(states, first, listed)
    assert key(audit) == expected and spark.conf.get("spark.sql.shuffle.partitions") == before
    # Partitions follow the rows, and no period goes to one task.
    plan = merged["window-states"]._jdf.queryExecution().optimizedPlan().toString()
    assert max(int(n) for n in re.findall(r"RepartitionByExpression \[.*\], (\d+)", plan)) > 8
    run = merged["window-states"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in run and "SortMergeJoin" not in run
