"""Feature tables, audit tables and feature-set files.

Schemas are given, not inferred, wherever the caller knows them: inference reads
the data twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FEATURE_SETS = "map<string, map<string, array<string>>>"
BYTE_ORDER_MARK = "﻿"


def _read(spark: SparkSession, path: str, schema: StructType | str | None) -> DataFrame:
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "json":
        return reader.json(path)
    if kind == "csv":
        return reader.csv(path, header=True, inferSchema=schema is None)
    raise ValueError(f"cannot tell the format of {path}: expected .parquet, .csv or .json")


def read_feature_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, target: str = "target"
) -> DataFrame:
    """A table that must contain the target column."""
    df = _read(spark, path, schema)
    if target not in df.columns:
        raise ValueError(f"table {path} has no column {target!r}")
    return df


def read_registry(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, StructType | str] | None = None,
    target: str = "target",
    skip_missing: bool = False,
) -> dict[str, DataFrame]:
    """Named lazy tables; with skip_missing, names without a file are left out."""
    tables = {}
    for name, path in paths.items():
        try:
            tables[name] = read_feature_table(spark, path, (schemas or {}).get(name), target)
        except AnalysisException as error:
            if not (skip_missing and error.getCondition() == "PATH_NOT_FOUND"):
                raise
    return tables


def union_registry(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All tables of a registry under each other, told apart by `dataset`."""
    parts = [df.withColumn("dataset", F.lit(name)) for name, df in tables.items()]
    if not parts:
        raise ValueError("the registry is empty")
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more, allowMissingColumns=True)
    return united


def read_audit(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | str | None = None,
    label: str = "audit table",
) -> DataFrame:
    """The first of several candidate paths that exists."""
    for path in paths:
        try:
            return _read(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"{label} not found at any of {list(paths)}")


def write_audit(df: DataFrame, path: str) -> None:
    """Replace a table; the format follows the suffix (parquet or csv)."""
    writer = df.write.mode("overwrite")
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        writer.csv(path, header=True)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"cannot tell the format of {path}: expected .parquet or .csv")


def read_feature_sets(spark: SparkSession, path: str) -> DataFrame:
    """Rows (dataset, set_name, position, feature) of a nested JSON file.

    The file is one object {dataset: {set: [feature, ...]}}, possibly with a byte
    order mark. Dynamic keys are a map, so a new dataset needs no new schema.
    """
    text = spark.read.text(path, wholetext=True)
    clean = F.ltrim(F.regexp_replace("value", BYTE_ORDER_MARK, ""))
    nested = text.select(F.from_json(clean, FEATURE_SETS).alias("m"))
    sets = nested.select(F.explode("m").alias("dataset", "sets"))
    named = sets.select("dataset", F.explode("sets").alias("set_name", "features"))
    return named.select("dataset", "set_name", F.posexplode("features").alias("position", "feature"))


def feature_sets_json(sets: DataFrame) -> DataFrame:
    """The inverse: one row with the nested JSON text of a small set table."""
    lists = sets.groupBy("dataset", "set_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "feature"))), lambda s: s["feature"]).alias("fs")
    )
    per_dataset = lists.groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("set_name", "fs"))).alias("sets")
    )
    return per_dataset.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("dataset", "sets")))).alias("value")
    )


def winner_models(results: DataFrame) -> DataFrame:
    """(dataset, model, feature_set) of the models an earlier step settled on."""
    return results.select("dataset", "model", "feature_set").dropDuplicates()
