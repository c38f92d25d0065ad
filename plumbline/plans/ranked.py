"""Feature scores, rankings and feature sets over lines of two line statuses."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import constants as C
from plumbline.functions import tidy
from plumbline.operators import scores as E
from plumbline.operators import selection as G
from plumbline.plans.catalogue import query
from plumbline.plans.views import num, rnd

FEATURES = ["quantity", "price_k", "discount", "tax", "partkey_m", "suppkey_m", "line", "month"]
DATASETS = ("F", "O")

LINES = """lines_in AS (
  SELECT l_linestatus AS dataset, CAST(l_returnflag = 'R' AS INT) AS y, l_quantity AS quantity,
         l_extendedprice / CAST(1000 AS DOUBLE) AS price_k, l_discount AS discount, l_tax AS tax,
         CAST(l_partkey % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS partkey_m,
         CAST(l_suppkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS suppkey_m,
         CAST(l_linenumber AS DOUBLE) AS line, CAST(month(l_shipdate) AS DOUBLE) AS month FROM lineitem)"""


def lines(t):
    return t("lineitem").select(
        F.col("l_linestatus").alias("dataset"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("price_k"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        ((F.col("l_partkey") % 1000).cast("double") / F.lit(1000.0)).alias("partkey_m"),
        ((F.col("l_suppkey") % 100).cast("double") / F.lit(100.0)).alias("suppkey_m"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.month("l_shipdate").cast("double").alias("month"),
    )


def per_feature(expr: str, where: str = "") -> str:
    """UNION over features of one aggregate per dataset; {f} is the feature."""
    return " UNION ALL ".join(
        f"SELECT dataset, '{f}' AS feature, {expr.format(f=f)} AS score FROM lines_in {where} GROUP BY dataset" for f in FEATURES
    )


VARIANCE = f"variance AS ({per_feature('var_pop({f})')})"
CORRELATION = f"correlation AS ({per_feature('coalesce(abs(corr({f}, y)), 0)')})"
MOMENTS = " UNION ALL ".join(
    f"SELECT dataset, '{f}' AS feature, y, CAST(count({f}) AS DOUBLE) AS n, avg({f}) AS m, var_pop({f}) AS v FROM lines_in GROUP BY dataset, y"
    for f in FEATURES
)
ANOVA = f"""moments AS ({MOMENTS}),
grand AS (SELECT dataset, feature, sum(n) AS n_all, sum(n * m) / sum(n) AS g, sum(n * v) AS within, count(*) AS k FROM moments GROUP BY ALL),
anova AS (SELECT dataset, feature, (sum(n * (m - g) * (m - g)) / (max(k) - 1)) / (max(within) / (max(n_all) - max(k))) AS score
  FROM moments JOIN grand USING (dataset, feature) GROUP BY ALL)"""
INNER = [k / 10 for k in range(1, 10)]
CUTS = "cut AS (SELECT dataset, " + ", ".join(
    f"list_sort(list_distinct([{', '.join(f'round(quantile_cont({f}, {num(p)}), 9)' for p in [0.0, *INNER, 1.0])}])) AS e_{f}" for f in FEATURES
) + " FROM lines_in GROUP BY dataset)"
COUNTED = " UNION ALL ".join(
    f"SELECT dataset, '{f}' AS feature, {f} AS value, y, CAST(count(*) AS DOUBLE) AS n, any_value(e_{f}) AS e FROM lines_in JOIN cut USING (dataset) GROUP BY dataset, {f}, y"
    for f in FEATURES
)
MUTUAL = f"""{CUTS}, counted AS ({COUNTED}),
joint AS (SELECT dataset, feature, (SELECT count(*) FROM (SELECT unnest(e[2:len(e) - 1]) AS edge) WHERE edge < value) AS level, y, sum(n) AS n FROM counted GROUP BY ALL),
info AS (SELECT *, sum(n) OVER (PARTITION BY dataset, feature, level) AS nl, sum(n) OVER (PARTITION BY dataset, feature, y) AS nc,
  sum(n) OVER (PARTITION BY dataset, feature) AS na FROM joint),
mutual AS (SELECT dataset, feature, sum(n / na * ln(n * na / (nl * nc))) AS score FROM info GROUP BY ALL)"""


def scores_query(name: str, cte: str, table: str, build):
    @query(name, f"WITH {LINES}, {cte} SELECT dataset, feature, {rnd('score')} AS score FROM {table}")
    def _(t):
        return build(lines(t)).select("dataset", "feature", tidy(F.col("score")).alias("score"))


scores_query("e01_variance", VARIANCE, "variance", lambda d: E.variance_scores(d, FEATURES, ["dataset"]))
scores_query("e02_correlation", CORRELATION, "correlation", lambda d: E.correlation_scores(d, FEATURES, ["dataset"]))
scores_query(
    "e03_mutual_information",
    MUTUAL,
    "mutual",
    lambda d: E.mutual_information_scores(d, FEATURES, keys=["dataset"], digits=9),
)
scores_query("e04_anova", ANOVA, "anova", lambda d: E.anova_scores(d, FEATURES, ["dataset"]))

# The ranking table: four methods, ties at nine digits by feature name. Two of the
# methods stand in for wrapper methods, so that both families are present.
NAMES = {"VarianceThreshold": "variance", "Correlation": "correlation", "RFE": "anova", "L1_logreg": "suffix"}
SUFFIX = f"suffix AS ({per_feature('avg({f}) / (1 + stddev_pop({f}))')})"
UNITED = " UNION ALL ".join(f"SELECT dataset, '{m}' AS method, feature, score FROM {v}" for m, v in NAMES.items())
RANKING = f"""{LINES}, {VARIANCE}, {CORRELATION}, {ANOVA}, {SUFFIX}, united AS ({UNITED}),
ranking AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset, method ORDER BY round(score, 9) DESC, feature) AS INT) AS rank FROM united)"""


def ranking(t):
    rows = lines(t)
    scaled_mean = rows.groupBy("dataset").agg(
        *[F.expr(f"avg({f}) / (1 + stddev_pop({f}))").alias(f) for f in FEATURES]
    )
    tables = {
        "VarianceThreshold": E.variance_scores(rows, FEATURES, ["dataset"]),
        "Correlation": E.correlation_scores(rows, FEATURES, ["dataset"]),
        "RFE": E.anova_scores(rows, FEATURES, ["dataset"]),
        "L1_logreg": scaled_mean.unpivot(["dataset"], FEATURES, "feature", "score"),
    }
    parts = [s.select("dataset", F.lit(m).alias("method"), "feature", "score") for m, s in tables.items()]
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more)
    return G.rank_scores(united, ["dataset", "method"], tie_digits=9).select(*C.RANKING_COLUMNS)


@query(
    "e05_stability_grid",
    f"""WITH {RANKING}, base AS (SELECT dataset, feature FROM ranking WHERE method = 'Correlation' AND rank <= 4),
    g AS (SELECT dataset, feature, score, vt, row_number() OVER (PARTITION BY dataset, vt ORDER BY round(score, 9) DESC, feature) AS place
      FROM variance, (VALUES ({num(0.0)}), ({num(0.001)}), ({num(0.01)}), ({num(0.05)}), ({num(0.1)})) x(vt) WHERE score > vt)
    SELECT g.dataset, vt AS variance_threshold, top_n, '["' || string_agg(g.feature, '","' ORDER BY place) || '"]' AS shortlist_json,
      {rnd('count(base.feature) / CAST(4 AS DOUBLE)')} AS overlap_with_baseline
    FROM g JOIN (VALUES (2), (4), (6)) n(top_n) ON place <= top_n LEFT JOIN base ON base.dataset = g.dataset AND base.feature = g.feature
    GROUP BY g.dataset, vt, top_n""",
)
def _(t):
    rows = lines(t)
    baseline = G.top_k(ranking(t).where(F.col("method") == "Correlation"), 4)
    grid = G.stability_grid(
        E.variance_scores(rows, FEATURES, ["dataset"]), baseline, top_ns=(2, 4, 6), tie_digits=9
    )
    return grid.withColumn("overlap_with_baseline", tidy(F.col("overlap_with_baseline")))


@query("g01_ordinal_rank", f"WITH {RANKING} SELECT dataset, feature, rank FROM ranking WHERE method = 'Correlation'")
def _(t):
    scores = E.correlation_scores(lines(t), FEATURES, ["dataset"])
    return G.rank_scores(scores, ["dataset"], tie_digits=9).select("dataset", "feature", "rank")


@query("g02_ranking_table", f"WITH {RANKING} SELECT dataset, method, feature, {rnd('score')} AS score, rank FROM ranking")
def _(t):
    return ranking(t).withColumn("score", tidy(F.col("score")))


@query(
    "g03_grouped_rank",
    f"""WITH {RANKING} SELECT dataset, 'fixed' AS model, 'full' AS feature_set, method, feature, rank FROM ranking""",
)
def _(t):
    rows = ranking(t).drop("rank").withColumns({"model": F.lit("fixed"), "feature_set": F.lit("full")})
    ranked = G.rank_importance(rows.withColumn("score", F.round("score", 9)))
    return ranked.select("dataset", "model", "feature_set", "method", "feature", "rank")


@query("g04_top_k", f"WITH {RANKING} SELECT dataset, method, feature, rank FROM ranking WHERE rank <= 3")
def _(t):
    return G.top_k(ranking(t), 3).select("dataset", "method", "feature", "rank")


SHORTLIST = """means AS (SELECT dataset, feature, avg(rank) AS mean_rank FROM ranking WHERE method IN ('VarianceThreshold', 'Correlation') GROUP BY ALL),
short AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY mean_rank, feature) AS INT) AS place FROM means)"""


@query("g05_shortlist", f"WITH {RANKING}, {SHORTLIST} SELECT dataset, feature, {rnd('mean_rank')} AS mean_rank, place FROM short WHERE place <= 5")
def _(t):
    return G.shortlist(ranking(t), top_n=5).withColumn("mean_rank", tidy(F.col("mean_rank")))


def support(k: int, methods: str = "'RFE', 'L1_logreg'") -> str:
    return f"""tops AS (SELECT dataset, method, feature FROM ranking WHERE rank <= {k} AND method IN ({methods})),
sup AS (SELECT dataset, feature, count(DISTINCT method) AS support, (SELECT count(DISTINCT method) FROM tops u WHERE u.dataset = tops.dataset) AS n_methods
  FROM tops GROUP BY dataset, feature),
marked AS (SELECT *, sum(CAST(support >= n_methods AS INT)) OVER (PARTITION BY dataset) AS size,
  row_number() OVER (PARTITION BY dataset ORDER BY support DESC, feature) AS place FROM sup),
robust AS (SELECT dataset, feature, support FROM marked WHERE CASE WHEN size >= 3 THEN support >= n_methods ELSE place <= {k} END)"""


@query("g06_robust_set", f"WITH {RANKING}, {support(6)} SELECT dataset, feature, CAST(support AS BIGINT) AS support FROM robust")
def _(t):
    return G.robust_set(ranking(t), k=6)


@query("g06_robust_set_fallback", f"WITH {RANKING}, {support(2)} SELECT dataset, feature, CAST(support AS BIGINT) AS support FROM robust")
def _(t):
    return G.robust_set(ranking(t), k=2)


@query(
    "g06_min_support",
    f"""WITH {RANKING}, {support(4, "'VarianceThreshold', 'Correlation', 'RFE', 'L1_logreg'")} SELECT dataset, feature, CAST(support AS BIGINT) AS support FROM sup WHERE support >= 3""",
)
def _(t):
    return G.robust_set(ranking(t), tuple(NAMES), k=4, min_support=3)


@query("g07_available_sets", f"WITH {RANKING} SELECT dataset, 'full,shortlist,robust_D' AS feature_sets FROM ranking GROUP BY dataset")
def _(t):
    return G.available_sets(ranking(t)).withColumn("feature_sets", F.array_join("feature_sets", ","))


@query(
    "g08_resolve_set",
    f"""WITH {RANKING}, {SHORTLIST} SELECT dataset, feature FROM short WHERE place <= 12 AND feature NOT IN ('tax', 'line')""",
)
def _(t):
    table = ranking(t)
    catalogue = table.where(~F.col("feature").isin("tax", "line"))
    return G.resolve_set("shortlist", table, catalogue)


@query(
    "g09_method_agreement",
    f"""WITH {RANKING}, ks(k) AS (VALUES (3), (5)),
    m AS (SELECT DISTINCT dataset, method FROM ranking),
    p AS (SELECT a.dataset, a.method AS ma, b.method AS mb, k FROM m a JOIN m b ON a.dataset = b.dataset AND a.method < b.method, ks),
    o AS (SELECT p.dataset, ma, mb, k, (SELECT count(*) FROM ranking x JOIN ranking y ON x.dataset = y.dataset AND x.feature = y.feature
      WHERE x.dataset = p.dataset AND x.method = ma AND y.method = mb AND x.rank <= k AND y.rank <= k) AS n FROM p)
    SELECT dataset, ma AS method_a, mb AS method_b, k AS top_k, CAST(n AS BIGINT) AS overlap_count, {rnd('CAST(n AS DOUBLE) / (2 * k - n)')} AS jaccard FROM o""",
)
def _(t):
    return G.method_agreement(ranking(t), (3, 5)).withColumn("jaccard", tidy(F.col("jaccard")))


@query(
    "g10_method_pairs",
    f"""WITH {RANKING}, m AS (SELECT DISTINCT dataset, method FROM ranking)
    SELECT a.dataset, a.method AS method_a, b.method AS method_b FROM m a JOIN m b ON a.dataset = b.dataset AND a.method < b.method""",
)
def _(t):
    return G.method_pairs(ranking(t))


@query(
    "g15_distinct_counts",
    f"""SELECT l_linestatus AS dataset, CAST(count(DISTINCT l_returnflag) AS BIGINT) AS n_flags, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_suppliers
    FROM lineitem GROUP BY l_linestatus""",
)
def _(t):
    return t("lineitem").groupBy(F.col("l_linestatus").alias("dataset")).agg(
        F.count_distinct("l_returnflag").alias("n_flags"), F.count_distinct("l_suppkey").alias("n_suppliers")
    )


@query("b15_feature_name_search", f"WITH {RANKING} SELECT dataset, method, feature FROM ranking WHERE lower(feature) LIKE '%key%'")
def _(t):
    return G.features_like(ranking(t), "KEY").select("dataset", "method", "feature")


@query(
    "f08_importance_rows",
    f"""WITH {RANKING} SELECT dataset, 'fixed' AS model, 'full' AS feature_set, 'coef_abs' AS method, feature, {rnd('score')} AS score, rank FROM ranking
    WHERE method = 'Correlation'
    UNION ALL SELECT dataset, 'fixed', 'full', 'native_importance', feature, {rnd('score')}, rank FROM ranking WHERE method = 'RFE'""",
)
def _(t):
    rows = lines(t)
    united = G.importance_rows(E.correlation_scores(rows, FEATURES, ["dataset"]), None, "fixed", "full", "coef_abs").unionByName(
        G.importance_rows(E.anova_scores(rows, FEATURES, ["dataset"]), None, "fixed", "full", "native_importance")
    )
    return G.rank_importance(united.withColumn("score", F.round("score", 9))).withColumn("score", tidy(F.col("score")))


@query(
    "f06_selection_stability",
    f"""WITH {RANKING}, cut AS (SELECT dataset, method, quantile_cont(score, {num(0.7)}) AS c FROM ranking GROUP BY ALL),
    hit AS (SELECT r.dataset, r.feature, CAST(round(score, 12) >= round(c, 12) AS INT) AS s FROM ranking r JOIN cut USING (dataset, method))
    SELECT dataset, 'RF_importance' AS method, feature, CAST(sum(s) AS BIGINT) AS selected_count, 4 AS total_runs,
    {rnd('sum(s) / CAST(4 AS DOUBLE)')} AS stability_rate FROM hit GROUP BY dataset, feature""",
)
def _(t):
    runs = G.at_least_percentile(ranking(t), ["dataset", "method"], 0.7)
    table = G.selection_stability(
        runs.withColumns({"seed": F.col("method"), "method": F.lit("RF_importance")}), total_runs=4
    )
    return table.withColumn("stability_rate", tidy(F.col("stability_rate")))
