"""Filter-type feature scores: each is one grouped aggregate over all features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions import bin_right_closed, category
from plumbline.operators.ordered import collect_quantiles, feature_quantiles


def _rows(row: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    return row.unpivot(list(keys), list(features), "feature", "score")


def variance_scores(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Population variance per feature."""
    wide = df.groupBy(*keys).agg(*[F.var_pop(F.col(f).cast("double")).alias(f) for f in features])
    return _rows(wide, keys, features)


def correlation_scores(
    df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), y: str = "y"
) -> DataFrame:
    """Absolute Pearson correlation with the label; 0 where it is undefined."""
    label = F.col(y).cast("double")
    wide = df.groupBy(*keys).agg(
        *[F.coalesce(F.nanvl(F.abs(F.corr(F.col(f).cast("double"), label)), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features]
    )
    return _rows(wide, keys, features)


def anova_scores(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), y: str = "y") -> DataFrame:
    """One-way F statistic of each feature over the classes of the label.

    Class moments (count, mean, variance) are merged, not raw squares, so large
    values do not cancel.
    """
    moments = df.groupBy(*keys, y).agg(
        *[
            F.struct(
                F.count(f).cast("double").alias("n"),
                F.avg(F.col(f).cast("double")).alias("m"),
                F.var_pop(F.col(f).cast("double")).alias("v"),
            ).alias(f)
            for f in features
        ]
    )
    cells = ", ".join(f"named_struct('feature', '{f}', 'c', `{f}`)" for f in features)
    long = moments.select(*keys, F.expr(f"inline(array({cells}))")).select(*keys, "feature", "c.*").where("n > 0")
    totals = long.groupBy(*keys, "feature").agg(
        F.expr("sum(n)").alias("n_all"),
        F.expr("sum(n * m) / sum(n)").alias("grand"),
        F.expr("sum(n * v)").alias("within"),
        F.expr("double(count(*))").alias("k"),
    )
    joined = long.join(totals, [*keys, "feature"])
    between = joined.groupBy(*keys, "feature").agg(
        F.expr("sum(n * (m - grand) * (m - grand))").alias("between"),
        F.max("within").alias("within"),
        F.max("n_all").alias("n_all"),
        F.max("k").alias("k"),
    )
    score = F.expr("coalesce(try_divide(between / (k - 1), within / (n_all - k)), 0D)")
    return between.select(*keys, "feature", score.alias("score"))


def _counted_by_own_edges(
    df: DataFrame, numeric: Sequence[str], keys: Sequence[str], y: str, probs: Sequence[float], digits: int | None
) -> DataFrame:
    """Class counts (keys, feature, level, p, q), with bins from the quantiles of each key.

    Equal values are counted first, so the join carries one row per distinct value.
    """
    cells = ", ".join(f"named_struct('feature', '{f}', 'value', double(`{f}`))" for f in numeric)
    values = (
        df.select(*keys, F.col(y).alias("y"), F.expr(f"inline(array({cells}))"))
        .groupBy(*keys, "feature", "value")
        .agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("q"))
    )
    cut = feature_quantiles(df, numeric, probs, keys=keys, digits=digits)
    edges = F.array_sort(F.array_distinct("quantiles"))
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    placed = values.join(cut.select(*keys, "feature", inner.alias("inner")), [*keys, "feature"], "left")
    level = F.when(F.col("value").isNotNull(), F.size(F.filter("inner", lambda e: e < F.col("value"))))
    return placed.groupBy(*keys, "feature", level.alias("level")).agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def mutual_information_scores(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    keys: Sequence[str] = (),
    y: str = "y",
    bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Plug-in mutual information (nats) between each feature and the label.

    Numeric features are cut at their quantiles, those of each key's own rows if there
    are keys; nulls form a level.
    With counts n over (level, class), N * MI = sum n ln n - sum over levels
    - sum over classes + N ln N (each x ln x), so one shuffle of counts is enough.
    """
    probs = [k / bins for k in range(bins + 1)]
    own_edges = edges is None and bool(keys)
    if edges is None and numeric and not keys:
        edges = {f: sorted(set(q)) for f, q in collect_quantiles(df, numeric, probs, digits=digits).items()}

    def counted(columns: Mapping[str, Column]) -> DataFrame:
        cells = ", ".join(f"named_struct('feature', '{f}', 'level', `{f}`)" for f in columns)
        coded = df.select(*keys, F.col(y).alias("y"), *[c.alias(f) for f, c in columns.items()])
        return (
            coded.select(*keys, "y", F.expr(f"inline(array({cells}))"))
            .groupBy(*keys, "feature", "level")
            .agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("q"))
        )

    parts = []
    if numeric:
        # Bin numbers stay integers until they are counted.
        if own_edges:
            parts.append(_counted_by_own_edges(df, numeric, keys, y, probs, digits))
        else:
            inner = {f: (edges or {}).get(f, [])[1:-1] for f in numeric}
            parts.append(counted({f: bin_right_closed(f"double(`{f}`)", inner[f]) for f in numeric}))
    if categorical:
        parts.append(counted({f: category(F.col(f)) for f in categorical}))
    tables = [p.withColumn("level", F.col("level").cast("string")) for p in parts]
    joint = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])

    def xlogx(x: str) -> str:
        return f"(CASE WHEN {x} > 0 THEN {x} * ln(double({x})) ELSE 0D END)"

    sums = joint.groupBy(*keys, "feature").agg(
        F.expr(f"sum({xlogx('p')} + {xlogx('q')} - {xlogx('(p + q)')})").alias("inner_sum"),
        F.sum("p").alias("p"),
        F.sum("q").alias("q"),
    )
    score = F.expr(f"(inner_sum - {xlogx('p')} - {xlogx('q')} + {xlogx('(p + q)')}) / (p + q)")
    return sums.select(*keys, "feature", F.greatest(score, F.lit(0.0)).alias("score"))
