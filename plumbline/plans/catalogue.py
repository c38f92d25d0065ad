"""Registry of named queries: a Spark callable and, where possible, oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ("scans", "scalars", "prepared", "sampled", "ranked", "measured", "decided", "explained", "monitored", "fitted")


class Tables:
    """Lazy access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under a name, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"plumbline.plans.{module}")
