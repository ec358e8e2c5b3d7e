"""Parameterised SQL (FLT-10): values bound as parameters, identifiers allow-listed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, args: Mapping[str, object], tables: Mapping[str, DataFrame],
            order_by: str | None = None, allowed_order: Sequence[str] = ()) -> DataFrame:
    """Run ``sql`` with named parameter markers bound from ``args``.

    Values never enter the SQL text; DataFrames are passed as ``{name}``
    references.  An ORDER BY identifier must be in ``allowed_order``.
    """
    if order_by is not None:
        if order_by not in allowed_order:
            raise ValueError(f"ORDER BY column {order_by!r} is not allowed")
        sql = f"{sql} ORDER BY {order_by}"
    return spark.sql(sql, args=dict(args), **dict(tables))
