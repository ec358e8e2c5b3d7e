"""Layers and sinks (SRC-05..SRC-10): raw -> staging -> clean, logs, exports.

Raw inputs are never written: every writer refuses a target inside a raw
folder (:mod:`shelfwise.sources.raw`).  Targets live in the shared folder named by
``spark.checkpoint.dir`` (see :func:`shelfwise.session.scratch_dir`).  Tables are
versioned (:mod:`shelfwise.sources.versions`): a rebuild or an append shows whole or
not at all, whenever a job dies.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources import versions
from shelfwise.sources.driver import sql_type_name
from shelfwise.sources.raw import guard


def stage(df: DataFrame, path: str) -> DataFrame:
    """SRC-05: CREATE TABLE ... AS SELECT * (a full copy), read back."""
    return versions.replace(df, path)


def build_clean(df: DataFrame, rules: Mapping[str, Column], path: str) -> DataFrame:
    """SRC-06: CTAS with transformations (trim, label maps) into the clean layer."""
    return stage(df.withColumns(dict(rules)), path)


def append(df: DataFrame, path: str, run_id: str | None = None) -> bool:
    """SRC-07: INSERT ... SELECT.  A run that is repeated under its id adds nothing (returns False), an aborted one stays invisible."""
    return versions.append(df, path, run_id)


def publish(df: DataFrame, path: str) -> DataFrame:
    """SRC-08: DROP IF EXISTS + CREATE - an idempotent rebuild; readers see the old rows or the new ones, never none."""
    return versions.replace(df, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version of a table that these writers made."""
    return versions.read(spark, path, schema)


def describe(df: DataFrame) -> DataFrame:
    """SRC-09: one row per column - name, SQL type, nullable - plus its non-NULL count.

    The counts come from one aggregate pass; the schema rows are small.
    """
    return describe_with_rows(df).drop("row_count")


def describe_with_rows(df: DataFrame) -> DataFrame:
    """:func:`describe` plus the table's row count, from the same single pass."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count(f.name).alias(f"_c{i}") for i, f in enumerate(fields)])
    parts = ", ".join(f"'{f.name}', '{sql_type_name(f.dataType)}', {str(f.nullable).lower()}, `_c{i}`"
                      for i, f in enumerate(fields))
    return counts.selectExpr(
        "row_count", f"stack({len(fields)}, {parts}) AS (column_name, data_type, nullable, non_null_count)")


def export(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """SRC-10: save a result supporting a finding; returns it read back with its schema."""
    guard(path)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
        return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
    w.format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a written layer back with a declared schema (never inferred)."""
    return spark.read.schema(schema).format(fmt).load(path)
