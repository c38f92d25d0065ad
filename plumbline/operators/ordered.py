"""Running sums and exact quantiles without a global sort.

A window ordered over a whole table puts it into one task. Here values are first
counted (map-side, so a value repeated a billion times is one row), then cut into
range buckets; the window runs inside (keys, bucket) and each bucket is shifted by
the totals of the buckets before it. The cut points come from one
`approx_percentile` pass and only balance the buckets: results are exact for any
cuts. Their number is a parameter, so what returns to the driver is bounded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plumbline.functions import double, number
from plumbline.session import broadcast_few, default_buckets, stage

BUCKET = "bucket"
ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 2_000
MAX_ACCURACY = 10_000  # of percentile_approx; each task sends a sketch of about that many values


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Range buckets of about `ROWS_PER_BUCKET` rows, at least the default number; cuts of `MAX_BUCKETS` come back."""
    return max(default_buckets(spark), min(MAX_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def accuracy(buckets: int) -> int:
    return min(10 * buckets, MAX_ACCURACY)


def range_cuts(
    df: DataFrame, columns: Sequence[str], buckets: int | None = None
) -> dict[str, list[float]]:
    """Inner cut points of each column, about equal row counts apart."""
    buckets = buckets or default_buckets(df.sparkSession)
    shares = [k / buckets for k in range(1, buckets)]
    row = df.agg(
        *[F.percentile_approx(number(F.col(c)), shares, accuracy(buckets)).alias(c) for c in columns]
    ).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def with_buckets(df: DataFrame, cuts: Mapping[str, Sequence[float]], suffix: str = "__bucket") -> DataFrame:
    """Add `<column><suffix>` with the range bucket of each listed double column."""
    ready = [c for c in cuts if cuts[c]]
    if ready:
        df = Bucketizer(
            splitsArray=[[float("-inf"), *cuts[c], float("inf")] for c in ready],
            inputCols=ready,
            outputCols=[c + suffix for c in ready],
            handleInvalid="keep",
        ).transform(df)
    for c in cuts:
        if c not in ready:
            df = df.withColumn(c + suffix, F.lit(0.0))
    return df


def long_values(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    cuts: Mapping[str, Sequence[float]] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Rows (keys, feature, value, bucket) of the non-null numeric values.

    One pass: `inline` over an array of structs keeps the scan single and narrow.
    """
    cuts = cuts if cuts is not None else range_cuts(df, features)
    typed = df.select(*keys, *extra, *[number(F.col(c)).alias(c) for c in features])
    bucketed = with_buckets(typed, {c: cuts[c] for c in features})
    cells = ", ".join(f"named_struct('feature', '{c}', 'value', `{c}`, {bucket_sql(c)})" for c in features)
    long = bucketed.select(*keys, *extra, F.expr(f"inline(array({cells}))"))
    return long.where(F.col("value").isNotNull())


def bucket_sql(column: str) -> str:
    """Struct field with the bucket of a column.

    Never null, so a join on it adds no filter and the branches of
    `running_totals` can share one exchange.
    """
    return f"'{BUCKET}', coalesce(int(`{column}__bucket`), 0)"


def running_totals(
    counts: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
) -> DataFrame:
    """Add cum_<s> (running sum by `order`) and tot_<s> per keys.

    `counts` holds one row per (keys, bucket, order) and buckets are ranges of
    `order`. The sums of earlier buckets enter as one head row per bucket that
    sorts first, so the running sum starts from them: no join, and a hot key is
    spread over its buckets.
    """
    before = W.partitionBy(*keys, F.lit(0)).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys, F.lit(0))
    totals = counts.groupBy(*keys, BUCKET).agg(*[F.sum(s).alias(s) for s in sums])
    heads = totals.select(
        *keys,
        BUCKET,
        F.lit(1).alias("head"),
        F.lit(None).cast(counts.schema[order].dataType).alias(order),
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(s) for s in sums],
        *[F.sum(s).over(whole).alias("tot_" + s) for s in sums],
    )
    rows = counts.withColumns(
        {"head": F.lit(0), **{"tot_" + s: F.lit(None).cast("bigint") for s in sums}}
    ).unionByName(heads, allowMissingColumns=True)
    inside = (
        W.partitionBy(*keys, BUCKET)
        .orderBy(F.col("head").desc(), order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    ranked = rows.withColumns(
        {
            **{"cum_" + s: F.sum(s).over(inside) for s in sums},
            # Only the head carries totals, and it comes first.
            **{"tot_" + s: F.sum("tot_" + s).over(inside) for s in sums},
        }
    )
    return ranked.where(F.col("head") == 0).drop("head")


def quantiles_from_totals(
    ranked: DataFrame, keys: Sequence[str], probs: Sequence[float], digits: int | None = None
) -> DataFrame:
    """Exact linear-interpolated quantiles as an array column `quantiles`, and `n_values`, the distinct values.

    `ranked` comes from `running_totals` over a count column named n.
    """
    aggregates, cells = [], []
    for k, p in enumerate(probs):
        position = f"({double(p)} * (tot_n - 1))"
        for side, bound in (("lo", "floor"), ("hi", "ceil")):
            aggregates.append(
                F.expr(f"min(CASE WHEN cum_n > {bound}({position}) THEN value END)").alias(f"{side}{k}")
            )
        cell = f"lo{k} + (hi{k} - lo{k}) * ({position} - floor({position}))"
        cells.append(cell if digits is None else f"round({cell}, {digits})")
    found = ranked.groupBy(*keys).agg(F.first("tot_n").alias("tot_n"), F.count("value").alias("n_values"), *aggregates)
    return found.select(*keys, F.expr(f"array({', '.join(cells)})").alias("quantiles"), "n_values")


def value_counts(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys, BUCKET, "value").agg(F.count(F.lit(1)).alias("n"))


def feature_quantiles(
    df: DataFrame,
    features: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    cuts: Mapping[str, Sequence[float]] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """(keys, feature, quantiles[], n_values) of the numeric features of a wide table."""
    long = long_values(df, keys, features, cuts)
    group = [*keys, "feature"]
    ranked = running_totals(value_counts(long, group), group, "value", ["n"])
    return quantiles_from_totals(ranked, group, probs, digits)


def collect_quantiles(
    df: DataFrame,
    features: Sequence[str],
    probs: Sequence[float],
    cuts: Mapping[str, Sequence[float]] | None = None,
    digits: int | None = None,
) -> dict[str, list[float]]:
    """Fitted quantiles on the driver: len(features) x len(probs) numbers."""
    rows = feature_quantiles(df, features, probs, cuts=cuts, digits=digits).collect()
    return {r["feature"]: list(r["quantiles"]) for r in rows}


def _slot_offsets(marked: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(strata, __slot, __n, __off, stratum_n): rows per slot and in the slots before it."""
    totals = marked.groupBy(*strata, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    by_slot = W.partitionBy(*strata, F.lit(0)).orderBy("__slot").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*strata, F.lit(0))
    return totals.select(
        *strata,
        "__slot",
        "__n",
        F.coalesce(F.sum("__n").over(by_slot), F.lit(0)).alias("__off"),
        F.sum("__n").over(whole).alias("stratum_n"),
    )


def hashed_rank(
    df: DataFrame, digest: Column, strata: Sequence[str], digits: int = 3, limit: int | None = None
) -> DataFrame:
    """Add rank_no (1..n) and stratum_n: the order of `digest` inside each stratum.

    Leading hex digits of a hash are uniform, so they are the buckets: 16**digits
    windows per stratum, whatever the size of the stratum. Use 4 or 5 digits
    beyond about 10**10 rows. Row keys must be unique. With a `limit`, slots that begin
    beyond that rank are dropped before anything is sorted.
    """
    marked = df.withColumn("__digest", digest)
    marked = marked.withColumn("__slot", F.substring("__digest", 1, digits))
    offsets = _slot_offsets(marked, strata).drop("__n")
    if limit is not None:
        offsets = offsets.where(F.col("__off") < limit)
    inside = W.partitionBy(*strata, "__slot").orderBy("__digest")
    joined = marked.join(offsets, [*strata, "__slot"]).withColumn("__inner", F.row_number().over(inside))
    return joined.withColumn("rank_no", F.col("__inner") + F.col("__off")).drop(
        "__digest", "__slot", "__inner", "__off"
    )


def cut_digests(
    df: DataFrame, digest: Column, strata: Sequence[str], quotas: Mapping[str, Column], digits: int = 3
) -> DataFrame:
    """(strata, one column per quota): the digest of the row whose rank is the quota, null for a quota of 0.

    Quotas are expressions of stratum_n. Rows are counted per slot; only the slots in
    which a quota falls are sorted, and only their digests. A row is among the first
    `quota` ones if its digest is not above the cut, so nothing else is ranked. The slots in
    which quotas fall are few, so they go to the digests and not the digests to them.
    """
    marked = df.select(*strata, digest.alias("__digest")).withColumn("__slot", F.substring("__digest", 1, digits))
    offsets = stage(_slot_offsets(marked, strata), "offsets")
    names = list(quotas)
    asked = F.array(*[F.struct(F.lit(n).alias("name"), (quotas[n] - F.col("__off")).alias("need")) for n in names])
    hits = offsets.select(*strata, "__slot", "__n", F.inline(asked)).where("need between 1 and __n").drop("__n")
    inside = W.partitionBy(*strata, "__slot", "name").orderBy("__digest")
    found = marked.join(broadcast_few(hits), [*strata, "__slot"]).withColumn("__place", F.row_number().over(inside))
    cuts = found.where(F.col("__place") == F.col("need")).select(*strata, "name", F.col("__digest").alias("cut"))
    every = offsets.groupBy(*strata).agg(F.max("stratum_n").alias("stratum_n")).select(*strata, F.lit("").alias("name"), F.lit(None).cast("string").alias("cut"))
    return every.unionByName(cuts).groupBy(*strata).agg(*[F.max(F.when(F.col("name") == n, F.col("cut"))).alias(n) for n in names])
