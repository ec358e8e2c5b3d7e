"""Registry of named queries: a Spark plan and its DuckDB oracle SQL.

Each entry's builder takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the driver tables in ``sf_dir``; nothing is collected.
The oracle is an independent ANSI SQL statement over the same parquet
tables (DuckDB dialect), with identical column names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.driver import Tables, load
from shelfwise.sources.model import Model, from_driver

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    build: Builder
    oracle: str | None
    survey_id: str


REGISTRY: dict[str, Entry] = {}


def register(key: str, survey_id: str, oracle: str | None = None):
    """Register ``fn(t: Tables, m: Model) -> DataFrame`` under ``key``."""

    def deco(fn: Callable[[Tables, Model], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = load(spark, sf_dir)
            return fn(t, from_driver(t))

        build.__name__ = key
        build.__doc__ = fn.__doc__
        REGISTRY[key] = Entry(key, build, oracle.strip() if oracle else None, survey_id)
        return fn

    return deco
