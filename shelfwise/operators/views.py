"""Views (SV-06, SV-08, SV-09): named, lazy, storing no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def register_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """CREATE OR REPLACE VIEW: the plan is stored, not the rows."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def restrict(df: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Expose approved columns only; an unknown column is an error."""
    missing = [c for c in allow if c not in df.columns]
    if missing:
        raise ValueError(f"columns not present: {missing}")
    return df.select(*allow)


def drop_view(spark: SparkSession, name: str) -> bool:
    """DROP VIEW IF EXISTS; the underlying tables are untouched."""
    return spark.catalog.dropTempView(name)
