"""Splits, folds, samples and monitoring windows.

Every draw is decided by the md5 of (row key, seed): the same on any partitioning,
after a lost executor, and on another engine. Row keys must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from plumbline import constants as C
from plumbline.functions import hash_bits, hash_text, hash_uniform, number
from plumbline.operators.ordered import collect_quantiles, cut_digests, hashed_rank
from plumbline.session import broadcast_few, stage


def quota(n: Column, share: Column | float) -> Column:
    """Rows of a stratum that make up `share` of it, rounded half up."""
    return F.floor(n * share + F.lit(0.5))


def ranked(df: DataFrame, key: str, strata: Sequence[str], seed: int = C.SEED, digits: int = 3) -> DataFrame:
    """Random order inside each stratum: rank_no 1..stratum_n."""
    return hashed_rank(df, hash_text(seed, F.col(key)), strata, digits)


def _with_cuts(
    df: DataFrame, key: str, strata: Sequence[str], quotas: dict[str, Column], seed: int, digits: int
) -> DataFrame:
    """Rows with their digest and their stratum's cut digests; the rows themselves are not shuffled for it.

    A join by stratum would send a whole class to one task. The cuts are one row per stratum, so
    they are written and, unless strata are many, broadcast; many strata are spread by the join.
    """
    digest = hash_text(seed, F.col(key))
    cuts = stage(cut_digests(df, digest, strata, quotas, digits), "cuts")
    marked = df.withColumn("__digest", digest)
    if not strata:
        return marked.crossJoin(F.broadcast(cuts))  # one row
    return marked.join(broadcast_few(cuts), list(strata))


def split_two(
    df: DataFrame,
    key: str,
    strata: Sequence[str] = ("y",),
    test_share: float = 0.2,
    seed: int = C.SEED,
    names: tuple[str, str] = ("train", "test"),
    digits: int = 3,
) -> DataFrame:
    """Stratified split in a `split` column.

    With window keys among the strata this also splits many windows at once; a
    window that holds one class is then simply one stratum.
    """
    rows = _with_cuts(df, key, strata, {"__test": quota(F.col("stratum_n"), test_share)}, seed, digits)
    name = F.when(F.col("__digest") <= F.col("__test"), F.lit(names[1])).otherwise(F.lit(names[0]))
    return rows.withColumn("split", name).select(*df.columns, "split")


def split_three(
    df: DataFrame,
    key: str,
    strata: Sequence[str] = ("y",),
    test_share: float = 0.2,
    valid_share: float = 0.2,
    seed: int = C.SEED,
    digits: int = 3,
) -> DataFrame:
    """Stratified train / validation / test; the validation share is of the whole."""
    test = quota(F.col("stratum_n"), test_share)
    valid = quota(F.col("stratum_n") - test, valid_share / (1.0 - test_share))
    rows = _with_cuts(df, key, strata, {"__test": test, "__both": test + valid}, seed, digits)
    name = (
        F.when(F.col("__digest") <= F.col("__test"), F.lit("test"))
        .when(F.col("__digest") <= F.col("__both"), F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    return rows.withColumn("split", name).select(*df.columns, "split")


def folds(
    df: DataFrame, key: str, k: int = 5, strata: Sequence[str] = ("y",), seed: int = C.SEED, digits: int = 3
) -> DataFrame:
    """Stratified shuffled folds 0..k-1 in a `fold` column."""
    order = ranked(df, key, strata, seed, digits)
    fold = ((F.col("rank_no") - 1) % k).cast("int")
    return order.withColumn("fold", fold).drop("rank_no", "stratum_n")


def draw(
    df: DataFrame, key: str, size: int, strata: Sequence[str] = (), seed: int = C.SEED, digits: int = 3
) -> DataFrame:
    """`size` rows of each stratum, with a draw_no from 1 to size.

    Strata with fewer rows are drawn with replacement: slot i takes the row whose
    rank is a hash of i. Only such strata, smaller than `size`, join the slots. Rows in
    hash slots beyond the size are dropped before sorting.
    """
    order = hashed_rank(df, hash_text(seed, F.col(key)), strata, digits, limit=size)
    enough = F.col("stratum_n") >= size
    plain = order.where(enough & (F.col("rank_no") <= size)).withColumn("draw_no", F.col("rank_no"))
    short = order.where(~enough)
    slots = (
        short.where(F.col("rank_no") == 1)
        .select(*strata, F.col("stratum_n").alias("pool"), F.explode(F.sequence(F.lit(1), F.lit(size))).alias("slot"))
        .withColumn("rank_no", 1 + hash_bits(hash_text(seed, F.col("slot"))) % F.col("pool"))
        .select(*strata, "rank_no", F.col("slot").cast("bigint").alias("draw_no"))
    )
    repeated = short.join(slots, [*strata, "rank_no"])
    columns = [*df.columns, "draw_no"]
    return plain.select(*columns).unionByName(repeated.select(*columns))


def prior_sizes(size: int, share: float = C.POSITIVE_SHARE) -> tuple[int, int]:
    """Positives and negatives of a window with a raised share of positives."""
    positives = max(1, int(round(size * share)))
    return positives, max(1, size - positives)


def prior_shift(
    df: DataFrame, key: str, size: int, share: float = C.POSITIVE_SHARE, seed: int = C.SEED
) -> DataFrame:
    """Resample so that about `share` of the rows are positive."""
    positives, negatives = prior_sizes(size, share)
    pos = draw(df.where(F.col("y") == 1), key, positives, seed=f"{seed}+")
    neg = draw(df.where(F.col("y") == 0), key, negatives, seed=f"{seed}-")
    return pos.unionByName(neg.withColumn("draw_no", F.col("draw_no") + positives))


def covariate_shift(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    seed: int = C.SEED,
    strength: float = 0.8,
    fallback: float = 0.3,
    mask_share: float = 0.40,
) -> DataFrame:
    """Push the first two numeric features up and part of one category aside.

    A numeric feature gains 0.8 standard deviations (0.3 if it is constant) after
    its nulls became the median; 40 % of the rows get the last level, by name, of
    the first categorical feature. Fitted numbers are one small row.
    """
    moved = list(numeric[:2])
    medians = collect_quantiles(df, moved, [0.5], digits=9) if moved else {}
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.stddev_samp(number(F.col(c))).alias(f"sd_{c}") for c in moved],
        *[F.max(F.col(c).cast("string")).alias("last") for c in categorical[:1]],
        *[F.min(F.col(c).cast("string")).alias("first") for c in categorical[:1]],
    ).first()
    changed: dict[str, Column] = {}
    for c in moved:
        sd = stats[f"sd_{c}"]
        step = strength * sd if sd is not None and sd > 1e-8 else fallback
        middle = medians.get(c, [None])[0]
        changed[c] = F.coalesce(number(F.col(c)), F.lit(middle).cast("double")) + F.lit(step)
    for c in categorical[:1]:
        if stats["last"] is not None and stats["first"] != stats["last"]:
            hit = hash_uniform(hash_text(seed, F.col(key))) < mask_share
            kind = df.schema[c].dataType
            last = F.lit(stats["last"]) if isinstance(kind, StringType) else F.lit(stats["last"]).cast(kind)
            changed[c] = F.when(hit, last).otherwise(F.col(c))
    return df.withColumns(changed) if changed else df


def monitoring_windows(
    reference: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    size: int = 240,
    seed: int = C.SEED,
) -> DataFrame:
    """Four windows of equal size drawn from the reference, as rows.

    The size is the one asked for, or the number of reference rows if there are fewer.

    1 stable sample, 2 the same rows with shifted features, 3 a sample with more
    positives, 4 those rows with shifted features. Adds window_id, scenario and a
    row_key that is unique over all windows.
    """
    if size < C.MIN_WINDOW_SIZE:
        raise ValueError(f"window size must be at least {C.MIN_WINDOW_SIZE}")
    counts = {r["y"]: r["count"] for r in reference.groupBy("y").count().collect()}
    if not counts.get(0) or not counts.get(1):
        raise ValueError("the reference needs rows of both classes")
    size = min(size, sum(counts.values()))
    # Both draws are of fixed size and feed two windows each: written once.
    drawn = stage(
        draw(reference, key, size, seed=seed)
        .withColumn("__base", F.lit("stable"))
        .unionByName(prior_shift(reference, key, size, seed=seed).withColumn("__base", F.lit("prior"))),
        "drawn",
    )
    stable, prior = (drawn.where(F.col("__base") == b).drop("__base") for b in ("stable", "prior"))
    parts = []
    for number_, name, base, shifted in (
        (1, "stable", stable, False),
        (2, "covariate", stable, True),
        (3, "prior", prior, False),
        (4, "combined", prior, True),
    ):
        rows = covariate_shift(base, "draw_no", numeric, categorical, seed=f"{seed}|{number_}") if shifted else base
        typed = rows.withColumns({c: F.col(c).cast("double") for c in numeric})
        parts.append(
            typed.withColumns(
                {
                    "window_id": F.lit(number_),
                    "scenario": F.lit(name),
                    "row_key": F.concat_ws("-", F.lit(number_), F.col("draw_no")),
                }
            )
        )
    windows = parts[0]
    for more in parts[1:]:
        windows = windows.unionByName(more)
    return windows


def time_windows(df: DataFrame, time: str, width: str = "1 day", prefix: str = "w") -> DataFrame:
    """The same shape from an event-time column: one window per interval."""
    start = F.window(F.col(time), width)["start"]
    ordinal = F.unix_timestamp(start)
    return df.withColumns(
        {"window_id": ordinal, "scenario": F.concat(F.lit(prefix), F.date_format(start, "yyyyMMddHHmm"))}
    )


__all__ = [
    "covariate_shift",
    "draw",
    "folds",
    "monitoring_windows",
    "prior_shift",
    "prior_sizes",
    "quota",
    "ranked",
    "split_three",
    "split_two",
    "time_windows",
]
