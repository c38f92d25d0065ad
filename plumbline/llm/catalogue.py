"""Registry of this subpackage's queries, beside the one of the main package."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans.catalogue import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES: tuple[str, ...] = (
    "decontaminate",
    "neardup",
    "warc",
    "quality",
    "substrings",
    "rules",
    "secrets",
    "tokencount",
    "langid",
    "packing",
    "chat",
    "merkle",
    "vantage",
)


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under a name, with its SQL twin if there is one."""

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
        importlib.import_module(f"plumbline.llm.{module}")
