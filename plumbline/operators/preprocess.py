"""Imputation, scaling and one-hot encoding: fitted on one split, applied to any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from plumbline.functions import number
from plumbline.operators.ordered import collect_quantiles, hashed_rank
from plumbline.session import default_buckets, stage


def feature_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric (numbers and booleans) and categorical columns, in column order."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, (NumericType, BooleanType))]
    return numeric, [f.name for f in fields if f.name not in numeric]


def feature_type_table(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The same as rows, with what the columns hold: non-null values and distinct ones.

    Values are counted per (column, value) map-side first, so no column is gathered.
    """
    numeric, _ = feature_types(df, exclude)
    names = [f.name for f in df.schema.fields if f.name not in exclude]
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(n).alias("feature"),
                F.lit("numeric" if n in numeric else "categorical").alias("feature_type"),
                F.col(n).cast("string").alias("level"),
            )
            for i, n in enumerate(names)
        ]
    )
    keys = ["position", "feature", "feature_type"]
    counts = df.select(F.inline(cells)).groupBy(*keys, "level").agg(F.count("level").alias("n"))
    return counts.groupBy(*keys).agg(F.sum("n").alias("n_values"), F.count("level").alias("n_levels"))


def split_features_label(df: DataFrame, target: str = "target") -> DataFrame:
    """Features plus an integer label `y`; rows keep both, never two frames."""
    if target not in df.columns:
        raise ValueError(f"column {target!r} is missing")
    return df.withColumn("y", F.col(target).cast("int")).drop(*([target] if target != "y" else []))


@dataclass(frozen=True)
class Preprocessor:
    """Fitted numbers: a handful per numeric feature, the levels per category.

    `levels` holds those of features with few levels. Features in `wide` (with their number
    of levels) keep theirs in the written table `level_table` (feature, level, index, n):
    it is joined to the rows, never gathered. Their slots come last in the vectors.
    """

    medians: Mapping[str, float]
    means: Mapping[str, float]
    scales: Mapping[str, float]
    modes: Mapping[str, str]
    levels: Mapping[str, Sequence[str]]
    wide: Mapping[str, int] = field(default_factory=dict)
    level_table: DataFrame | None = None

    @property
    def names(self) -> list[str]:
        """Output names in vector order, without the slots of wide features (see `wide_names`)."""
        return [f"num__{c}" for c in self.medians] + [f"cat__{c}_{v}" for c, vs in self.levels.items() for v in vs]

    def wide_names(self) -> DataFrame:
        """(slot, name) of the wide features' vector slots."""
        start, base = len(self.names), F.lit(None).cast("long")
        for c, n in self.wide.items():
            base = F.when(F.col("feature") == c, F.lit(start)).otherwise(base)
            start += n
        return self.level_table.select((base + F.col("index")).alias("slot"), F.concat(F.lit("cat__"), "feature", F.lit("_"), "level").alias("name"))

    def imputed(self, df: DataFrame) -> DataFrame:
        filled = {c: F.coalesce(number(F.col(c)), F.lit(m)) for c, m in self.medians.items()}
        filled.update({c: F.coalesce(F.col(c).cast("string"), F.lit(m)) for c, m in self.modes.items()})
        return df.withColumns(filled) if filled else df

    def scaled(self, df: DataFrame) -> DataFrame:
        """Imputed columns plus num__<feature>."""
        done = self.imputed(df)
        return done.withColumns(
            {f"num__{c}": (F.col(c) - F.lit(self.means[c])) / F.lit(self.scales[c]) for c in self.medians}
        )

    def columns(self, df: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
        """All (or the wanted) output features as columns next to the input.

        Unseen levels are 0 in every column of their feature. A wanted name that
        was never fitted becomes a column of 0.0, so the order can be relied on.
        """
        done = self.scaled(df)
        flags = {
            f"cat__{c}_{v}": (F.col(c) == F.lit(v)).cast("double") for c, vs in self.levels.items() for v in vs
        }
        if wanted is None:
            return done.withColumns(flags)
        known = set(self.names)
        cells = {w: flags.get(w, F.col(w)) if w in known else F.lit(0.0) for w in wanted}
        return done.withColumns(cells)

    def vectors(self, df: DataFrame, selected: Sequence[str] | None = None, output: str = "features") -> DataFrame:
        """Sparse feature vectors; `selected` keeps those names, in that order.

        Categories go through index and one-hot stages whose last slot, the
        unknown level, is dropped: wide categories cost one sparse entry per row.
        """
        done = self.scaled(df)
        narrow = [c for c in self.levels if c not in self.wide]
        cats = [*narrow, *self.wide]
        inputs = [f"num__{c}" for c in self.medians]
        extra: list[str] = []
        if cats:
            for c, n in self.wide.items():
                # The size of the encoding stands in the column's metadata, so the encoder reads no rows.
                kind = {"ml_attr": {"type": "nominal", "name": f"{c}__index", "num_vals": n + 1}}
                table = self.level_table.where(F.col("feature") == c).select(F.col("level").alias(c), F.col("index").alias("__found"))
                index = F.coalesce("__found", F.lit(n)).cast("double").alias(f"{c}__index", metadata=kind)
                done = done.join(table, c, "left").select(*done.columns, index)
            for c in narrow:
                # One model per column: label arrays of unequal length cannot share one.
                indexer = StringIndexerModel.from_labels(list(self.levels[c]), c, f"{c}__index", handleInvalid="keep")
                done = indexer.transform(done)
            encoder = OneHotEncoder(
                inputCols=[f"{c}__index" for c in cats], outputCols=[f"{c}__hot" for c in cats], dropLast=True
            )
            done = encoder.fit(done).transform(done)
            inputs += [f"{c}__hot" for c in cats]
            extra = [f"{c}{s}" for c in cats for s in ("__index", "__hot")]
        full = "__all" if selected is not None else output
        assembled = VectorAssembler(inputCols=inputs, outputCol=full).transform(done)
        if selected is not None:
            position = {n: i for i, n in enumerate(self.names)}
            kept = [position[s] for s in selected if s in position]
            if not kept:
                raise ValueError("none of the selected features is known")
            assembled = VectorSlicer(inputCol=full, outputCol=output, indices=kept).transform(assembled)
            extra.append(full)
        return assembled.drop(*extra, *[f"num__{c}" for c in self.medians])


def known_features(names: Sequence[str], selected: Sequence[str]) -> list[str]:
    """Selected names that exist, in the requested order; none left is an error."""
    kept = [s for s in selected if s in set(names)]
    if not kept:
        raise ValueError("none of the selected features is known")
    return kept


def fit_preprocessor(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    max_levels: int = 1_000,
    digits: int | None = None,
) -> Preprocessor:
    """Medians, population mean and deviation after imputation, modes and levels.

    The driver gets the levels of features with at most `max_levels` of them (in order), and
    one row for any other feature, whose levels are numbered in a written table by the order of
    their hashes.
    """
    medians: dict[str, float] = {}
    means: dict[str, float] = {}
    scales: dict[str, float] = {}
    if numeric:
        # One pass for the moments and the cut points, one for the exact medians.
        buckets = default_buckets(df.sparkSession)
        shares = [k / buckets for k in range(1, buckets)]
        aggregates = [F.count(F.lit(1)).alias("n")]
        for c in numeric:
            v = number(F.col(c))
            aggregates += [
                F.count(v).alias(f"n_{c}"),
                F.avg(v).alias(f"m_{c}"),
                F.var_pop(v).alias(f"v_{c}"),
                F.percentile_approx(v, shares, 10 * buckets).alias(f"q_{c}"),
            ]
        row = df.agg(*aggregates).first()
        cuts = {c: sorted(set(row[f"q_{c}"] or [])) for c in numeric}
        found = collect_quantiles(df, numeric, [0.5], cuts, digits)
        for c in numeric:
            seen, empty = row[f"n_{c}"], row["n"] - row[f"n_{c}"]
            if not seen:
                raise ValueError(f"feature {c!r} has no values to impute from")
            medians[c] = found[c][0]
            mean = (seen * row[f"m_{c}"] + empty * medians[c]) / row["n"]
            spread = seen * (row[f"v_{c}"] + (row[f"m_{c}"] - mean) ** 2) + empty * (medians[c] - mean) ** 2
            means[c] = mean
            scales[c] = (spread / row["n"]) ** 0.5 or 1.0
    levels: dict[str, list[str]] = {c: [] for c in categorical}
    modes: dict[str, str] = {}
    if categorical:
        cells = ", ".join(f"named_struct('feature', '{c}', 'level', string(`{c}`))" for c in categorical)
        counted = (
            df.select(F.expr(f"inline(array({cells}))"))
            .where(F.col("level").isNotNull())
            .groupBy("feature", "level")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counted = stage(counted, "levels")
        best = F.min(F.struct((-F.col("n")).alias("n"), "level"))["level"]  # ties: the smallest level
        facts = {r["feature"]: r for r in counted.groupBy("feature").agg(F.count(F.lit(1)).alias("levels"), best.alias("mode")).collect()}
        for c in categorical:
            if c not in facts:
                raise ValueError(f"feature {c!r} has no values to impute from")
            modes[c] = facts[c]["mode"]
        wide = {c: facts[c]["levels"] for c in categorical if facts[c]["levels"] > max_levels}
        for r in counted.where(~F.col("feature").isin(list(wide))).select("feature", "level").collect():
            levels[r["feature"]].append(r["level"])
        for own in levels.values():
            own.sort()
        if wide:
            order = hashed_rank(counted.where(F.col("feature").isin(list(wide))), F.md5(F.col("level").cast("binary")), ["feature"])
            table = stage(order.select("feature", "level", (F.col("rank_no") - 1).cast("long").alias("index"), "n"), "level_table")
            return Preprocessor(medians, means, scales, modes, levels, wide, table)
    return Preprocessor(medians, means, scales, modes, levels)
