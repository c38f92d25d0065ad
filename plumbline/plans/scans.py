"""Reading, writing and checking tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import expectations as Q
from plumbline.plans.catalogue import query
from plumbline.plans.ranked import RANKING, ranking
from plumbline.plans.views import ORDERS_WIDE, SCORED, num, orders_wide, rnd, scored
from plumbline.session import scratch_folder
from plumbline.sources import tables as S


@query("a01_contract_scan", "SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INT) AS target FROM orders")
def _(t):
    path = scratch_folder(t.spark, "feature_table.csv")
    rows = t("orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("target")
    )
    S.write_audit(rows, path)
    return S.read_feature_table(t.spark, path, "o_orderkey bigint, o_totalprice double, target int")


@query(
    "a02_registry_union",
    """SELECT 'orders' AS dataset, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
    UNION ALL SELECT 'events', CAST(count(*) AS BIGINT), CAST(sum(event_id) AS BIGINT) FROM events""",
)
def _(t):
    paths = {"orders": t.path("orders"), "gone": t.path("no_such_table")}
    kept = S.read_registry(t.spark, paths, target="o_orderkey", skip_missing=True)
    events = S.read_registry(t.spark, {"events": t.path("events")}, target="event_id")
    tables = {
        "orders": kept["orders"].select(F.col("o_orderkey").alias("key")),
        "events": events["events"].select(F.col("event_id").alias("key")),
    }
    united = S.union_registry(tables)
    return united.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))


RANKING_SCHEMA = "dataset string, method string, feature string, score double, rank int"


@query("a03_audit_with_fallback", f"WITH {RANKING} SELECT dataset, method, feature, rank FROM ranking")
def _(t):
    path = scratch_folder(t.spark, "feature_ranking.parquet")
    S.write_audit(ranking(t), path)
    found = S.read_audit(t.spark, [path + ".elsewhere.parquet", path], RANKING_SCHEMA, "feature ranking")
    return found.select("dataset", "method", "feature", "rank")


@query(
    "a04_feature_sets_json",
    f"""WITH {RANKING} SELECT dataset, method AS set_name, CAST(rank - 1 AS INT) AS position, feature FROM ranking WHERE rank <= 3""",
)
def _(t):
    sets = ranking(t).where(F.col("rank") <= 3).select(
        "dataset", F.col("method").alias("set_name"), (F.col("rank") - 1).alias("position"), "feature"
    )
    path = scratch_folder(t.spark, "feature_sets")
    S.feature_sets_json(sets).coalesce(1).write.text(path)
    return S.read_feature_sets(t.spark, path)


@query("a05_winner_models", f"WITH {SCORED} SELECT DISTINCT dataset, model, variant AS feature_set FROM scored")
def _(t):
    return S.winner_models(scored(t).withColumnRenamed("variant", "feature_set"))


@query("a06_csv_sink", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(max(value), 6) AS top FROM events GROUP BY event_type")
def _(t):
    table = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 6).alias("top"))
    path = scratch_folder(t.spark, "event_counts.csv")
    S.write_audit(table, path)
    return S.read_audit(t.spark, [path], "event_type string, n bigint, top double")


@query(
    "a07_json_columns",
    """SELECT event_id, '{"a_type":"' || event_type || '","b_user":"' || CAST(user_id AS VARCHAR) || '"}' AS params_json,
    '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS list_json FROM events""",
)
def _(t):
    from plumbline.functions import sorted_json

    user = F.col("user_id").cast("string")
    params = F.create_map(F.lit("b_user"), user, F.lit("a_type"), F.col("event_type"))
    return t("events").select(
        "event_id",
        sorted_json(params).alias("params_json"),
        F.to_json(F.array("event_type", user)).alias("list_json"),
    )


@query("a08_column_contract", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(t):
    return Q.contract(t("customer"), ["c_custkey", "c_mktsegment", "c_acctbal"], "customer")


@query(
    "q01_exact_columns_and_rows",
    """SELECT 'exact_columns' AS check_name, CAST(0 AS BIGINT) AS violations
    UNION ALL SELECT 'null_keys', CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) FROM orders""",
)
def _(t):
    rows = Q.require_rows(t("orders"), "orders")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    wrong = 0 if Q.exact_columns(rows, names) else 1
    checks = {"exact_columns": F.max(F.lit(wrong)), "null_keys": F.count_if(F.col("o_orderkey").isNull())}
    return Q.violations(rows, checks)


@query(
    "q02_domain_sets",
    """SELECT 'status_outside' AS check_name, CAST(count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS violations FROM orders
    UNION ALL SELECT 'status_missing', CAST(3 - count(DISTINCT o_orderstatus) + 1 AS BIGINT) FROM orders""",
)
def _(t):
    checks = {
        "status_outside": Q.outside_domain("o_orderstatus", ["F", "O"]),
        "status_missing": Q.missing_from("o_orderstatus", ["F", "O", "P", "X"]),
    }
    return Q.violations(t("orders"), checks)


@query(
    "q03_group_cardinality",
    """SELECT o_orderpriority, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_distinct FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey) <> 3""",
)
def _(t):
    return Q.group_sizes_off(t("orders"), ["o_orderpriority"], "o_custkey", 3)


@query(
    "q04_range_checks",
    """SELECT 'price' AS check_name, CAST(count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS BIGINT) AS violations FROM orders
    UNION ALL SELECT 'blank_priority', CAST(count(*) FILTER (WHERE length(trim(o_orderpriority)) = 0) AS BIGINT) FROM orders""",
)
def _(t):
    checks = {"price": Q.outside_range("o_totalprice", 1000.0, 400000.0), "blank_priority": Q.blank("o_orderpriority")}
    return Q.violations(t("orders"), checks)


@query(
    "q05_split_isolation",
    f"""WITH {SCORED} SELECT 'split' AS check_name, CAST(count(*) FILTER (WHERE split <> 'validation') AS BIGINT) AS violations FROM scored""",
)
def _(t):
    return Q.violations(scored(t), {"split": Q.outside_domain("split", ["validation"])})


@query("b01_split_label", f"WITH {ORDERS_WIDE} SELECT row_id, {rnd('total_k')} AS total_k, n_lines, CAST(n_lines > {num(4)} AS INT) AS y FROM orders_wide")
def _(t):
    from plumbline.operators.preprocess import split_features_label

    rows = orders_wide(t).select("row_id", F.round("total_k", 6).alias("total_k"), "n_lines")
    return split_features_label(rows.withColumn("target", F.col("n_lines") > 4))


@query(
    "b02_feature_types",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS INT) AS position, '{c}' AS feature,
        CASE WHEN any_value(typeof({c})) IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'BOOLEAN') THEN 'numeric' ELSE 'categorical' END AS feature_type,
        count({c}) AS n_values, count(DISTINCT {c}) AS n_levels FROM events"""
        for i, c in enumerate(("event_id", "ts", "user_id", "event_type", "value", "props"))
    ),
)
def _(t):
    from plumbline.operators.preprocess import feature_type_table

    return feature_type_table(t("events"))
